"""The write ordering of pipeline.run: each write waits only for the writes
it reads, a failure fails its dependents, and nothing new starts after it."""

import threading
import time

import pytest

from orderlake.plans.pipeline import _Writes


def test_a_write_waits_only_for_its_inputs():
    log, lock = [], threading.Lock()
    slow_done = threading.Event()

    def step(name, delay=0.0, event=None):
        def run():
            time.sleep(delay)
            with lock:
                log.append(name)
            if event is not None:
                event.set()
            return name
        return run

    w = _Writes(parallelism=4)
    w.add("slow", step("slow", 0.5, slow_done))
    w.add("fast", step("fast"))
    w.add("after_fast", step("after_fast"), needs=["fast"])
    w.add("after_both", step("after_both"), needs=["slow", "after_fast"])
    w.wait()
    w.close()
    assert log.index("after_fast") < log.index("slow")      # did not wait for "slow"
    assert log[-1] == "after_both"


def test_a_failure_stops_dependents_and_new_writes():
    ran = []

    def ok(name, delay=0.0):
        def run():
            time.sleep(delay)
            ran.append(name)
        return run

    def boom():
        time.sleep(0.2)                           # "slow_ok" is running by now
        raise ValueError("gate failed")

    w = _Writes(parallelism=2)
    w.add("bad", boom)
    w.add("slow_ok", ok("slow_ok", 0.5))
    w.add("child", ok("child"), needs=["bad"])
    w.add("ready_after_failure", ok("ready_after_failure"), needs=["slow_ok"])
    with pytest.raises(ValueError, match="gate failed"):
        w.wait()
    w.close()
    assert "slow_ok" in ran                       # already running: finishes
    assert "child" not in ran                     # reads the failed table
    assert "ready_after_failure" not in ran       # would start after the failure

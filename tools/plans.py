"""Summarise the physical plans of the metrics and the main operators.

    python tools/plans.py [sf_dir] > PLANS.md

Runs the pipeline once (tables under spark.checkpoint.dir), then for each
plan reports its exchanges, joins, aggregates and the scans' pruned schemas
and pushed filters, taken from ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake.operators import dedup  # noqa: E402
from orderlake.plans import pipeline  # noqa: E402
from orderlake.registry import Frames  # noqa: E402
from orderlake.session import build_session, scratch_path  # noqa: E402
from orderlake.sinks import TableStore  # noqa: E402
from orderlake.sources import fixtures  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(name: str, df) -> str:
    text = formatted(df)
    tree = text.split("\n\n")[0]
    ops = []
    for line in tree.splitlines():
        m = re.match(r"^[\s+:\-]*(.*?) \(\d+\)$", line)
        if m:
            op = m.group(1)
            ops.append("Scan parquet" if op.startswith("Scan parquet") else op)
    exchanges = [ln.strip() for ln in text.splitlines()
                 if ln.startswith("Arguments: hashpartitioning") or
                 ln.startswith("Arguments: SinglePartition") or
                 ln.startswith("Arguments: rangepartitioning")]
    scans = re.findall(r"\(\d+\) Scan parquet (\S*)\n(.*?)(?=\n\n)", text, re.S)
    out = [f"### {name}", "", f"* operators: {', '.join(dict.fromkeys(ops))}",
           f"* shuffles: {len(exchanges)}" + (f" — {'; '.join(e[11:] for e in exchanges)}"
                                             if exchanges else "")]
    for table, body in scans:
        rs = re.search(r"ReadSchema: (.*)", body)
        pf = re.search(r"PushedFilters: (.*)", body)
        out.append(f"* scan {table or '(table)'}: reads `{rs.group(1) if rs else '?'}`"
                   + (f", pushed `{pf.group(1)}`" if pf and pf.group(1) != "[]" else ""))
    return "\n".join(out) + "\n"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16, "orderlake-plans")
    store = TableStore(spark, scratch_path(spark, "plans"), prefix="plans_")
    res = pipeline.run(spark, fixtures.sources(spark, sf_dir), store,
                       null_gate_mode="report", as_of="2002-01-01")
    print(f"# Physical plans (sf dir `{sf_dir}`, local[8], AQE on; plans before AQE "
          "re-optimisation, so broadcasts chosen at run time are not shown)\n")
    print("## Metrics over the written star schema\n")
    for k, df in res.metrics.items():
        print(summary(k, df))
    fr = Frames(spark, sf_dir)
    print("## Operators\n")
    print(summary("keep_one_per_key (newest event per user)",
                  dedup.keep_one_per_key(fixtures.customer_snapshots(spark, sf_dir),
                                         ["user_id"], ["ts", "event_id"])))
    print(summary("exact_dedup + classification (bronze orders)", fr.bronze.orders))
    print(summary("last_write_wins (bronze FX)", fr.bronze.fx_rates))
    print(summary("fill_daily_rates (silver FX)",
                  pipeline.silver.fx_rates(store.read("bronze", "fx_rates"))))
    print(summary("order_items (from written silver tables, FX and catalog size-checked broadcasts)",
                  pipeline.silver.order_items(store.read("silver", "orders"),
                                              store.read("silver", "product"),
                                              store.read("silver", "fx_rates"),
                                              res.counts["silver.fx_rates"],
                                              res.counts["silver.product"])))
    print(summary("silver products (category tree size-checked broadcast)",
                  pipeline.silver.products(store.read("bronze", "product"),
                                           store.read("bronze", "cat_tree"),
                                           res.counts["bronze.cat_tree"])))
    print(summary("dim_product (latest rates size-checked broadcast)",
                  pipeline.gold.dim_product(store.read("silver", "product"),
                                            store.read("silver", "fx_rates"),
                                            res.counts["silver.fx_rates"])))
    spark.stop()


if __name__ == "__main__":
    main()

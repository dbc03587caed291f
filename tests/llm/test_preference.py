import os

import duckdb
from pyspark.sql import functions as F

from orderlake.llm import preference, queries


def brute(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in talks.items()}
    out = {}
    for pair in {c // 2 for c in talks}:
        c, r = talks.get(2 * pair), talks.get(2 * pair + 1)
        n = 0
        while c and r and n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1

        def side(turns):
            if turns is None:
                return None, []
            text, spans = "", []
            for role, said in turns[n:]:
                text += f"<|{role}|>\n"
                if role == "assistant":
                    spans.append((len(text), len(text) + len(said)))
                text += said + "\n"
            return text, spans

        prompt = "".join(f"<|{a}|>\n{b}\n" for a, b in (c or [])[:n])
        out[pair] = (n, prompt, *side(c), *side(r))
    return out


def rows_of(df):
    return {r["pair_id"]: (r["n_common"], r["prompt"], r["chosen"], r["cs"] or [], r["rejected"],
                           r["rs"] or []) for r in df.select(
        "*", F.transform("chosen_spans", lambda x: F.array(x["start"], x["end"])).alias("cs"),
        F.transform("rejected_spans", lambda x: F.array(x["start"], x["end"])).alias("rs")).collect()}


def pairs(turns):
    talks = preference.conversations(turns).withColumn("pair_id", F.floor(F.col("conv_id") / 2))
    return preference.preference_pairs(talks.where("pmod(conv_id, 2) = 0"),
                                       talks.where("pmod(conv_id, 2) = 1"), "pair_id")


def test_odd_conversations(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"),
            (1, 1, "assistant", "no"), (1, 2, "user", "é\U0001f600"), (1, 3, "assistant", "ok"),
            (2, 0, "user", "same"), (2, 1, "assistant", "a"), (3, 0, "user", "same"),
            (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (4, 0, None, None), (4, 0, "user", ""),
            (5, 0, "", ""), (5, None, "user", "x"), (6, 1, "assistant", "alone"), (None, 0, "user", "n"),
            (9, 2, "system", "b" * 100000), (8, 2, "system", "b" * 100000), (8, 3, "assistant", "")]
    turns = spark.createDataFrame([(*r, "k", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, c string, t int")
    got = {k: (v[0], v[1], v[2], [tuple(x) for x in v[3]], v[4], [tuple(x) for x in v[5]])
           for k, v in rows_of(pairs(turns)).items()}
    assert got == brute(rows)
    assert pairs(turns.limit(0)).count() == 0


def test_query_against_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    path = f"{sf}/conversations.parquet"
    con.sql(f"create view conversations as select * from '{path + '/*' if os.path.isdir(path) else path}'")
    want = con.sql(queries.ORACLE["op10_preference_pairs"]).df()
    got = queries.op10_preference_pairs(spark, sf).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    order = lambda x: x[columns].sort_values("pair_id").reset_index(drop=True)
    assert order(got).equals(order(want))

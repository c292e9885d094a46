import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chatloom.operators import tree_aggregate as ta


@pytest.mark.parametrize("chunk", [1 << 16, 1 << 3])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(ta, "CHUNK_ROWS", chunk)
    rnd = random.Random(1)
    rows = [(k, rnd.choice(["hot"] * 6 + ["a", "b", "", None]), rnd.choice([None, *"xyz"]), rnd.choice([None, "2023-01-01", "2023-01-02"]), "q" * rnd.randint(0, 3), 1) for k in range(2000)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "id long, name string, session string, at string, q string, _chunk int")
    want = defaultdict(lambda: [0, set(), None])
    for i, name, session, at, q, _ in rows:
        w = want[name]
        w[0] += 1
        w[1] |= {session} - {None}
        w[2] = max(x for x in (w[2], (at is not None, at or "", i, q)) if x is not None)
    got = {r.name: (r.n_rows, r.n_distinct, (r.latest.at is not None, r.latest.at or "", r.latest.id, r.latest.q)) for r in ta.per_key(df, "name", "session", ["at", "id"], ["q"]).collect()}
    assert got == {k: (n, len(s), last) for k, (n, s, last) in want.items()}


def test_heavy_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 12 + [("",)] * 20 + [("c",)], "k string")
    assert {r.k for r in ta.heavy_keys(df, "k", 20).collect()} == {"a", "b"}
    assert ta.heavy_keys(df.limit(0), "k", 20).collect() == []
    assert ta.per_key(df.limit(0), "k").collect() == []


def test_rounds_follow_the_chunks():
    assert [ta.rounds(n) for n in (0, 1, 16, 17, 256, 257, 4096, 10**7)] == [0, 0, 0, 1, 1, 2, 2, 5]


def test_no_reducer_receives_a_hot_key_whole(spark, monkeypatch):
    monkeypatch.setattr(ta, "CHUNK_ROWS", 4)
    states, chunks, merge = ta._states(spark.range(0, 4000, 1, 2).selectExpr("'hot' as k"), "k")
    assert states.count() == 1000 and chunks == 2 * 16**3  # 500 chunks in each of two partitions
    seen = []
    for _ in range(ta.rounds(chunks)):
        merged = states.groupBy("_key", F.expr(f"_chunk div {ta.FAN_IN}").alias("_chunk"))
        seen.append(merged.count().agg(F.max("count")).first()[0])
        states = merged.agg(*merge)
    assert max(seen) <= ta.FAN_IN and states.count() <= ta.FAN_IN
    plan = ta.per_key(spark.range(0, 4000, 1, 2).selectExpr("'hot' as k", "id"), "k")._jdf.queryExecution().toString()
    assert "_chunk" in plan and plan.count("Exchange hashpartitioning(_key") == ta.rounds(chunks) + 1

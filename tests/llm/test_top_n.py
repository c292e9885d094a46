import random

import pandas as pd
import pytest

from chatloom.llm import top_n as tn

SCHEMA = "y string, r string, sim double, g string, rank int"


def brute(rows, n):
    best = {}
    for g, i, s in rows:
        if g is not None and i is not None and s is not None and s == s:
            best.setdefault(g, {})
            best[g][i] = max(s, best[g].get(i, s))
    return {(g, i, s, k + 1) for g, items in best.items() for k, (i, s) in enumerate(sorted(items.items(), key=lambda p: (-p[1], p[0]))[:n])}


@pytest.mark.parametrize("rows_of_file, rows_of_group", [(1 << 20, 1 << 12), (20, 1 << 12), (150, 4)])
def test_against_brute_force(spark, monkeypatch, rows_of_file, rows_of_group):
    monkeypatch.setattr(tn, "FILE_ROWS", rows_of_file)
    monkeypatch.setattr(tn, "ROW_GROUP_ROWS", rows_of_group)
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot", "hot", "a", "b", "é", "", None]), rnd.choice([f"q{rnd.randrange(60)}", "", None, "中"]), rnd.choice([0.1, 0.5, 0.5, rnd.random(), float("nan"), None, -0.0, 0.0, float("inf")])) for _ in range(800)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = [(r.y, r.r, r.sim, r["rank"]) for r in tn.top_n(df, "y", "r", "sim", 5).collect()]
    assert set(got) == brute(rows, 5) and len(got) == len(set(got))


def test_row_groups_are_skipped(spark):
    df = spark.range(60000).selectExpr("'one' as g0", "concat('item number ', id) as i0", "(id * 7919 % 60000) / 60000 as s0")
    counts = tn.cluster(df, "g0", "i0", "s0").mapInPandas(tn.read_best(5, count_skips=True), "n_read long, n_skipped long").toPandas()
    assert counts["n_skipped"].sum() > counts["n_read"].sum() > 0


def test_small_groups_leave_with_their_row_group(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = [(f"g{k // 4:04d}", f"i{k % 4}", float(-k % 7)) for k in range(4000)]
    rows = sorted(rows, key=lambda r: (r[0], -r[2], r[1]))
    pq.write_table(pa.table([pa.array(c) for c in zip(*rows)], names=["g", "i", "s"]), tmp_path / "a.parquet", row_group_size=102)
    with pq.ParquetFile(tmp_path / "a.parquet") as f:
        parts = list(tn._read_file(f, 5))
    assert len(parts) == 41 and len(parts[-1][0]) <= 40 * 8  # only groups on a border wait for the end
    got = pd.concat([p for p, skip in parts if not skip])
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(rows)


def test_a_hot_group_fills_several_files(spark, monkeypatch):
    monkeypatch.setattr(tn, "FILE_ROWS", 500)
    df = spark.range(4000).selectExpr("'one' as g0", "concat('i', id % 1000) as i0", "cast(id as double) as s0")
    assert tn.cluster(df, "g0", "i0", "s0").count() == 8
    got = [(r.i0, r.s0) for r in tn.top_n(df, "g0", "i0", "s0", 5).orderBy("rank").collect()]
    assert got == [(f"i{k}", 3000.0 + k) for k in (999, 998, 997, 996, 995)]


def test_ties_and_repeats():
    x = pd.DataFrame({"g": ["a"] * 4, "i": ["y", "x", "x", "z"], "s": [1.0, 1.0, 0.5, 1.0]})
    assert tn._best(x, 2)["i"].tolist() == ["x", "y"]


def test_empty(spark):
    assert tn.top_n(spark.createDataFrame([], SCHEMA), "y", "r", "sim", 5).collect() == []
    assert tn.top_n(spark.createDataFrame([("a", None, 1.0, "", 1)], SCHEMA), "y", "r", "sim", 5).collect() == []

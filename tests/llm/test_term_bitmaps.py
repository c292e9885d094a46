import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatloom.llm import term_bitmaps as tb


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 65536])
def test_containers(n):
    low = np.sort(np.random.default_rng(n).choice(65536, n, replace=False)).astype(np.uint16)
    assert np.array_equal(tb.members(tb.packed(low)), low)
    assert (len(tb.packed(low)) == 8192) == (n >= 4096)


@pytest.mark.parametrize("chunk", [1 << 16, 50])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(tb, "CHUNK_ROWS", chunk)
    rnd = random.Random(3)
    rows = [(rnd.randrange(400) * 1000, rnd.choice([None, "", " \t　", *(("　".join(rnd.choice(["a", "b", "中", "é", "x y", "z\tz", f"w{rnd.randrange(300)}"]) for _ in range(rnd.randint(1, 6))) for _ in range(8)))]), "t", 1) for _ in range(900)]
    df = spark.createDataFrame(rows, "id long, segment string, term string, n int")
    for by_id in (None, "id"):
        occ, where, having = Counter(), defaultdict(set), set()
        for k, (i, s, *_) in enumerate(rows):
            for t in (s or "").replace("\t", " ").replace("　", " ").split(" "):
                if t:
                    occ[t] += 1
                    where[t].add(i if by_id else k)
                    having.add(i if by_id else k)
        want = {t: (n, len(where[t]), "rare" if len(where[t]) <= 2 else "common" if len(where[t]) * 10 > len(having) else None) for t, n in occ.items()}
        got = tb.term_frequencies(df, "segment", by_id).collect()
        assert {r.term: (r.n_occurrences, r.n_rows, r.mark) for r in got} == want and len(got) == len(want)


def test_bit_sets_and_long_texts(spark):
    df = spark.range(20000).selectExpr("id", "case when id % 2 = 0 then 'even all' else 'all' end as s").unionByName(spark.createDataFrame([(20001, "q " * 300000)], "id long, s string"))
    got = {r.term: (r.n_occurrences, r.n_rows, r.mark) for r in tb.term_frequencies(df, "s", "id").collect()}
    assert got == {"all": (20000, 20000, "common"), "even": (10000, 10000, "common"), "q": (300000, 1, "rare")}


def test_empty(spark):
    df = spark.createDataFrame([], "s string")
    assert tb.term_frequencies(df, "s").collect() == []
    assert tb.term_frequencies(spark.createDataFrame([(None,), (" ",)], "s string"), "s").collect() == []

import itertools
import math
import random
from collections import Counter

import pytest

from chatloom.llm import item_pairs as ip

SCHEMA = "pno string, vipno string, prodno string, item string, n_ab int, k0 string"


def brute(rows):
    baskets = {}
    for pno, vip, item in rows:
        if item is not None:
            baskets.setdefault((pno, vip), set()).add(item)
    one = Counter(i for b in baskets.values() for i in b)
    two = Counter(p for b in baskets.values() for p in itertools.combinations(sorted(b), 2))
    return {(a, b): (n, one[a], one[b], len(baskets)) for (a, b), n in two.items()}


@pytest.mark.parametrize(("chunk", "run"), [(512, 1 << 20), (3, 7)])
def test_against_brute_force(spark, monkeypatch, chunk, run):
    monkeypatch.setattr(ip, "CHUNK_ITEMS", chunk)
    monkeypatch.setattr(ip, "RUN_CODES", run)
    rnd = random.Random(1)
    rows = [(rnd.choice(["1", "2", "3", None, ""]), rnd.choice(["a", None, "b"]), rnd.choice([f"p{k}" for k in range(12)] + [None, "", "é", "z" * 300])) for _ in range(300)]
    rows += [("hot", "v", f"h{k:02d}") for k in range(30)] * 2 + [("alone", None, "only")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = ip.item_pairs(df, ["pno", "vipno"], "prodno").collect()
    want = brute(rows)
    assert {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n_baskets) for r in got} == want and len(got) == len(want)
    for r in got[:50]:
        n, a, b, t = r.n_ab, r.n_a, r.n_b, r.n_baskets
        assert r.lift == pytest.approx(n * t / (a * b))
        odds = (n + 0.5) * (t - a - b + n + 0.5) / ((a - n + 0.5) * (b - n + 0.5))
        assert r.odds_ratio == pytest.approx(odds)
        assert r.log_odds_z == pytest.approx(math.log(odds) / math.sqrt(sum(1 / x for x in (n + 0.5, a - n + 0.5, b - n + 0.5, t - a - b + n + 0.5))))
    least = {(r.item_a, r.item_b): r.n_ab for r in ip.item_pairs(df, ["pno", "vipno"], "prodno", 3).collect()}
    assert least == {k: v[0] for k, v in want.items() if v[0] >= 3}


def test_empty(spark):
    assert ip.item_pairs(spark.createDataFrame([], SCHEMA), ["pno", "vipno"], "prodno").collect() == []
    assert ip.item_pairs(spark.createDataFrame([("1", "a", None, "", 1, "")], SCHEMA), ["pno", "vipno"], "prodno").collect() == []

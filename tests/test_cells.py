import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.functions import similarity as sm
from chatloom.operators import cells as ce


def _made(n, seed, most=150):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abxyzCG不的 一二三") for _ in range(rnd.choice([0, 1, 9, 63, 64, 65, most]))) for _ in range(12)]
    return sorted({"".join(rnd.choice("ab不的C") if rnd.random() < 0.1 else c for c in rnd.choice(base)) for _ in range(n)})


def _wanted(texts, t):
    i, j = np.triu_indices(len(texts), 1)
    d = np.concatenate([sm.edit_distances([texts[a]], [texts[b]]) for a, b in zip(i, j)])
    n = np.array([len(x) for x in texts])
    long, short = np.maximum(n[i], n[j]), np.minimum(n[i], n[j])
    sim = (np.float32(1) - (d.astype(float) / long).astype(np.float32)).astype(float) * np.where((long >= 8) & (long > 2 * short), 0.5, 1.0)
    return {(int(a), int(b)): s for a, b, s in zip(i, j, sim) if s >= t}


@pytest.mark.parametrize(("t", "seed"), [(0.66, 1), (0.8, 2), (0.3, 3)])
def test_pairs_of_a_cell_against_all_pairs(t, seed, monkeypatch):
    monkeypatch.setattr(ce, "HELD", 500)
    texts = _made(160, seed)
    found = [(min(p), max(p), s) for a, b, sim in ce.Cell(pa.array(texts), t).pairs() for *p, s in zip(a.tolist(), b.tolist(), sim)]
    want = _wanted(texts, t)
    assert {(i, j): s for i, j, s in found} == want and len(found) == len(want) > 50


@pytest.mark.parametrize("block", [40, 1 << 13])
def test_cells_of_groups_give_each_pair_once(spark, block, monkeypatch):
    monkeypatch.setattr(ce, "BLOCK", block)
    monkeypatch.setattr(ce, "SMALL", 16)
    groups = {1: _made(90, 4, 30), 2: _made(8, 5, 30), 3: ["alone"], 4: _made(12, 6, 30)}
    df = spark.createDataFrame([(g, k, x) for g, texts in groups.items() for k, x in enumerate(texts)], "g long, id long, x string")
    found = ce.in_cells(df, 0.66).withColumn("low", F.least("i", "j")).withColumn("high", F.greatest("i", "j")).collect()
    want = {(g, i, j): s for g, texts in groups.items() if len(texts) > 1 for (i, j), s in _wanted(texts, 0.66).items()}
    assert {(r.g, r.low, r.high): r.sim for r in found} == want and len(found) == len(want)


def test_unlike_pairs_of_long_texts_cost_no_recurrence(monkeypatch):
    # All texts of 100 characters share their characters, so that counting these tells no pair apart; the plain recurrence takes minutes.
    def refused(*_):
        raise AssertionError("a pair that words of bits tell apart went to the plain recurrence")

    monkeypatch.setattr(sm, "edit_distances", refused)
    rnd = random.Random(7)
    texts = ["不" + "".join(rnd.sample("abcdefghijklmnopqrstuvwxyz" * 4, 100)) for _ in range(600)]
    began = time.time()
    assert sum(len(a) for a, *_ in ce.Cell(pa.array(texts), 0.66).pairs()) == 0 and time.time() - began < 60


def test_overlaps_of_a_cell_against_all_pairs():
    from collections import Counter

    rnd = random.Random(8)
    words = [[rnd.choice(["a", "b", "cc", "不", "d", ""]) for _ in range(rnd.randint(1, 12))] for _ in range(150)]
    texts = [chr(0x5000 + k) * 5 for k in range(150)]  # of no common character
    found = [(min(p), max(p), s) for a, b, sim in ce.Cell(pa.array(texts), 0.7, pa.array(words)).pairs() for *p, s in zip(a.tolist(), b.tolist(), sim)]
    bags, want = [Counter(w) for w in words], {}
    for i in range(150):
        for j in range(i + 1, 150):
            both = sum((bags[i] & bags[j]).values())
            if (s := both / (len(words[i]) + len(words[j]) - both)) >= 0.7:
                want[i, j] = s
    assert {(i, j): s for i, j, s in found} == want and len(found) == len(want) > 50

import itertools
import random
import re

import numpy as np
import pytest

from chatloom.llm import near_copies as nc


def brute(rows, t, width, least):
    texts = {k: re.sub(r"\s+", "", x) for k, x in rows if k is not None and x is not None}
    texts = {k: x for k, x in texts.items() if len(x) >= max(least, width)}
    grams = {k: {x[i : i + width] for i in range(len(x) - width + 1)} for k, x in texts.items()}
    return {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if len(grams[a] & grams[b]) >= t * len(grams[a] | grams[b]) - 1e-12}


def corpus(n, seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh中文字") for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    rows = []
    for k in range(n):
        if rows and rnd.random() < 0.5:
            x = list(rnd.choice(rows)[1])
            for _ in range(rnd.randint(0, 8)):
                x[rnd.randrange(len(x))] = rnd.choice("xyz1")
            if rnd.random() < 0.3:
                x = x[len(x) // 2 :] + x[: len(x) // 2]
            rows.append((k + 1, "".join(x)))
        else:
            rows.append((k + 1, " ".join(rnd.choice(words) for _ in range(rnd.randint(8, 25)))))
    return rows


def expand(members, links):
    of = {}
    for r in members.collect():
        of.setdefault(r.class_id, []).append(r.log_id)
    pairs = {tuple(sorted(p)) for ids in of.values() for p in itertools.combinations(ids, 2)}
    for r in links.collect():
        pairs |= {tuple(sorted((x, y))) for x in of[r.a] for y in of[r.b]}
    return pairs


@pytest.mark.parametrize(("t", "width", "least", "leaf", "cell"), [(0.6, 3, 40, 64, 1 << 15), (0.6, 3, 0, 4, 1 << 15), (0.6, 3, 20, 8, 20), (0.8, 5, 0, 4, 30), (0.3, 2, 0, 64, 40)])
def test_against_brute_force(spark, monkeypatch, t, width, least, leaf, cell):
    rows = corpus(260, 5)
    rows += [(1001, rows[3][1]), (1002, rows[3][1] + " "), (1003, None), (1004, ""), (None, rows[3][1]), (1005, "long " * 3000), (1006, "long " * 3000 + "x")]
    monkeypatch.setattr(nc, "LEAF", leaf)
    monkeypatch.setattr(nc, "CELL", cell)
    df = spark.createDataFrame([(k, x, "n", 1) for k, x in rows], "log_id long, question string, class_id string, a int")
    members, links = nc.near_copies(df, "log_id", "question", t, width, least)
    got = links.collect()
    assert len({(r.a, r.b) for r in got}) == len(got) and all(r.a < r.b for r in got)
    assert expand(members, links) == brute(rows, t, width, least)


def test_empty(spark):
    members, links = nc.near_copies(spark.createDataFrame([], "log_id long, question string"), "log_id", "question")
    assert members.collect() == [] and links.collect() == []


@pytest.mark.parametrize(("leaf", "fan"), [(4, 2), (8, 3), (32, 8)])
def test_trees_open_all_pairs_that_the_bounds_leave(monkeypatch, leaf, fan):
    import pyarrow as pa

    monkeypatch.setattr(nc, "LEAF", leaf)
    monkeypatch.setattr(nc, "FAN", fan)
    rng = np.random.default_rng(leaf)
    m = 700
    size = np.sort(rng.integers(20, 90, m))
    sets = [rng.choice(200, n, replace=False) if k % 3 else np.arange(n) for k, n in enumerate(size)]
    h = nc._mixed(np.concatenate(sets).astype(np.uint64))
    point, excess = nc.points(h, size)
    table = pa.table({
        "token": np.zeros(m, np.int64), "side": np.zeros(m, np.int32), "id": np.arange(m), "size": size.astype(np.int32), "place": (rng.random(m) * 0.4 * size).astype(np.int32),
        "excess": excess.astype(np.int32), "point": [p.tobytes() for p in point],
    })
    e = nc.Entries(table)
    i, j = np.triu_indices(m, 1)
    want = set(zip(*(x.tolist() for x in e.bounded(i, j, 0.6))))
    met = [p for a, b in nc._tree(e, 0, m, 0.6) for p in zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())]
    assert len(met) == len(set(met)) and set(met) == want and len(want) > 1000


def test_cells_bring_every_pair_together_once():
    ids = np.arange(50, dtype=np.int64)
    token, side, pick = nc._cells(np.full(50, 7, np.uint64), ids, np.full(50, 4))
    met = []
    for c in np.unique(token):
        for i, j in itertools.combinations(np.flatnonzero(token == c), 2):
            if side[i] != side[j] or side[i] == 0:
                met.append(tuple(sorted((pick[i], pick[j]))))
    assert sorted(met) == list(itertools.combinations(range(50), 2))

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.functions import similarity as sm
from chatloom.operators import cluster as cl


def sim(a, b):
    d = float(sm.edit_distances([a], [b])[0])
    s = 1 - d / max(len(a), len(b)) if max(len(a), len(b)) else 0
    far = max(len(a), len(b)) >= 8 and (len(a) > 2 * len(b) or 2 * len(a) < len(b))
    return s * (0.5 if far else 1)


@pytest.mark.parametrize("t", [0.66, 0.8])
def test_similar_in_group_loses_no_pair(spark, t):
    rnd = random.Random(1)
    texts = ["", "的", "的的", "的 最和", "不", "CG", "怎么安装的手机", "怎么安装手机", "最最最最最最怎么"]
    for _ in range(120):
        base = "".join(rnd.choice("的 最和不CGab中文字怎么") for _ in range(rnd.randint(1, 16)))
        texts += [base, base[1:] + rnd.choice("ab不的")]
    df = spark.createDataFrame([(i % 2, x, "n") for i, x in enumerate(texts)] + [(0, None, "n"), (0, "怎么安装手机", "n")], "g int, q string, key string")
    got = {(r.group, r.a, r.b) for r in cl.similar_in_group(df, "g", "q", t).collect()}
    want = set()
    for g in (0, 1):
        own = {x for i, x in enumerate(texts) if i % 2 == g} | ({"怎么安装手机"} if g == 0 else set())
        want |= {(g, a, b) for a, b in itertools.permutations(own, 2) if max(len(a), len(b)) and sim(a, b) >= t - 1e-7}
    assert {(g, a, b) for g, a, b in got if abs(sim(a, b) - t) > 1e-5} == {(g, a, b) for g, a, b in want if abs(sim(a, b) - t) > 1e-5}


def test_density_clusters(spark):
    rows = [("g", x) for x in ("aaaaaaaaaa", "aaaaaaaaab", "aaaaaaaabb", "zzzzzzzzzz", "aaaaaaaaaa")] + [("h", "q"), ("h", None)]
    got = {(r.group, r.cluster, r.text, r.flag) for r in cl.density_clusters(spark.createDataFrame(rows, "g string, t string"), "g", "t", 0.85).collect()}
    assert got == {("g", 0, "aaaaaaaaab", 1), ("g", 0, "aaaaaaaaaa", 1), ("g", 0, "aaaaaaaabb", 1), ("g", 1, "zzzzzzzzzz", 1), ("h", 0, "q", 1)}
    weights = {(r.group, r.cluster): (r["size"], r.weight) for r in cl.cluster_weights(cl.density_clusters(spark.createDataFrame(rows, "g string, t string"), "g", "t", 0.85)).collect()}
    assert weights == {("g", 0): (3, 1.0), ("g", 1): (1, 0.0), ("h", 0): (1, 0.0)}


@pytest.mark.parametrize("seed", [1, 2])
def test_density_clusters_in_rounds(spark, seed):
    rnd = random.Random(seed)
    rows = [(None, "怎么安装手机"), (None, None), (7, "alone")]
    for g in (None, 0, 1):
        bases = ["".join(rnd.choice("abcdef") for _ in range(6)) for _ in range(8)]
        rows += [(g, "".join(rnd.choice("abcdef") if rnd.random() < 0.2 else c for c in rnd.choice(bases))) for _ in range(60)]
    df = spark.createDataFrame(rows, "g int, t string")
    read = lambda most: sorted(map(tuple, cl.density_clusters(df, "g", "t", 0.66, most).collect()), key=repr)
    want = read(cl.MAX_PAIRS)
    assert read(50) == want and {f for *_, f in want} == {0, 1} and len(want) == len({r for r in rows if r[1]})


def test_rounds_end_once_a_task_can_finish(spark, monkeypatch):
    """Pairs of a large group and of a chain of texts, which takes many rounds: rounds end at ``most`` rows, and the plan doesn't grow with them."""
    rnd = random.Random(1)
    links = {(0, a, b): rnd.randint(7, 10) / 10 for a, b in itertools.combinations(range(30), 2)}
    links |= {(g, a, b): rnd.randint(7, 10) / 10 for g in (0, 5) for a in range(30, 66) for b in range(a + 1, min(66, a + rnd.randint(2, 4)))}
    links |= {(0, 0, 30): 0.7, (0, 3, 31): 0.9, (0, 29, 45): 0.8}
    rows = [x for (g, a, b), s in links.items() for x in ((g, a, b, s), (g, b, a, s))] + [(g, a, None, None) for g, a in {(g, x) for g, *ab in links for x in ab}]
    pairs = spark.createDataFrame(rows, "group long, a long, b long, sim double")
    tags = []
    monkeypatch.setattr(cl, "materialize", lambda df, tag, made=cl.materialize: tags.append(tag) or made(df, tag))
    want = []
    for g in (0, 5):
        own = np.array([x[1:] for x in rows if x[0] == g], float)
        low = own[:, 0].min()
        want += [(g, int(c), int(x + low), int(f)) for x, c, f in zip(*cl._greedy(own[:, 0] - low, own[:, 1] - low, own[:, 2]))]
    n = {}
    for most in (0, 300):
        tags.clear()
        made = cl._rounds(pairs, "long", most)
        assert sorted(map(tuple, made.collect())) == sorted(want)
        n[most] = tags.count("cluster-links") - 1
        assert made._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 4
    assert 1 <= n[300] <= 2 and n[0] > 4


def test_large_group_is_not_refused(spark):
    df = spark.createDataFrame([("g", "aaaaaaaaaa"), ("g", "aaaaaaaaab")], "g string, t string")
    assert cl.density_clusters(df, "g", "t", 0.85, most=0).count() == 2


def test_canopy(spark):
    rows = [(1, "怎么安装手机", "怎么 安装 手机"), (2, "怎么安装手机呢", "怎么 安装 手机 呢"), (3, "退款多久到账", "退款 多久 到账"), (4, None, "x")]
    got = {r.text: r.cluster for r in cl.canopy(spark.createDataFrame(rows, "o int, q string, s string"), "q", "s", "o", 0.4, 0.4).collect()}
    assert got["怎么安装手机"] == got["怎么安装手机呢"] != got["退款多久到账"] and len(got) == 3


def sequential(rows, t1, t2):
    """rows: order, text, segment. The plain statement of canopies."""
    from collections import Counter

    def far(p, q):
        x, y = (z.replace(" ", "") for z in (p[1], q[1]))
        a, b = (Counter((z[2] or "").split(" ")) for z in (p, q))
        both = sum((a & b).values())
        jac = both / (sum(a.values()) + sum(b.values()) - both)
        if not x and not y:
            return 1 - jac
        edit = np.float32(1) - np.float32(float(sm.edit_distances([x], [y])[0]) / max(len(x), len(y)))  # the rule's 32-bit ratio
        half = max(len(x), len(y)) >= 8 and (len(x) > 2 * len(y) or 2 * len(x) < len(y))
        return 1 - max(float(edit) * (0.5 if half else 1.0), jac)

    first = {}
    for r in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        first.setdefault(r[1], r)
    texts, centres = sorted(first.values(), key=lambda r: (r[0], r[1])), []
    for r in texts:
        if all(far(r, c) >= t2 for c in centres):
            centres.append(r)
    of = {c[1]: [r[1] for r in texts if r is c or far(r, c) <= t1] for c in centres}
    order = sorted(of, key=lambda c: (-sum(map(len, of[c])) / len(of[c]), c))
    out = {r[1]: len(order) for r in texts}
    for k in range(len(order) - 1, -1, -1):
        out |= dict.fromkeys(of[order[k]], k)
    return out


@pytest.mark.parametrize(("t1", "t2", "seed"), [(0.4, 0.4, 1), (0.6, 0.5, 2), (0.3, 0.6, 3)])
def test_canopy_against_the_sequential_pass(spark, t1, t2, seed):
    rnd = random.Random(seed)
    words = ["怎么", "安装", "手机", "a1", "的", "和", "不", "最", "打不开", "了"]
    rows = [(5, "", None), (6, "的的", ""), (7, "x" * 300, "x"), (8, None, "n")]
    for k in range(130):
        pick = [rnd.choice(words) for _ in range(rnd.randint(1, 6))]
        rows.append((rnd.randrange(40), rnd.choice(["", " "]).join(pick), rnd.choice([" ".join(pick), " ".join(pick[:2]), None])))
    rows = [(o * 1000 + k, x, s) for k, (o, x, s) in enumerate(rows)]  # no ties between different rows of one text
    df = spark.createDataFrame(rows, "o int, q string, s string")
    got = {r.text: r.cluster for r in cl.canopy(df, "q", "s", "o", t1, t2).collect()}
    assert got == sequential(rows, t1, t2) and len(set(got.values())) > 3
    assert cl.canopy(df, "q", "s", "o", t1, t2, 10).count() == 10 and cl.canopy(df.limit(0), "q", "s", "o", t1, t2).collect() == []


def test_rarest_terms_and_ids(spark):
    df = spark.createDataFrame([(1, 0, "a", ["x", "y"]), (1, 0, "b", ["x"]), (1, 0, "c", ["x", "z"])], "group int, cluster int, text string, tokens array<string>")
    assert {r.text: r.term for r in cl.rarest_terms(df, "tokens").collect()} == {"a": "y", "b": "x", "c": "z"}
    assert df.select(cl.cluster_id("group", "cluster").alias("i")).distinct().count() == 1


def test_kmeans_groups(spark):
    df = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["c", "d"]) for i in range(20)], "i int, t array<string>")
    got = cl.kmeans_groups(df, "t", 10, features=64)
    assert got.count() == 20 and got.select("group").distinct().count() <= 2
    assert cl.kmeans_groups(df, "t", 1000).select(F.max("group")).first()[0] == 0


def test_kmeans_centres_do_not_pass_the_driver(spark):
    # Dense centres would take 300 times 2^22 numbers, 10 GB.
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, [rnd.choice("abcdefgh") + str(i % 40) for _ in range(3)]) for i in range(600)] + [(600, []), (601, None)], "i int, t array<string>")
    got = cl.kmeans_groups(df, "t", 2, features=1 << 22).collect()
    assert len(got) == 602 and {r.i for r in got} == set(range(602)) and 200 < len({r.group for r in got}) <= 301 and max(r.group for r in got) < 301


def test_kmeans_rows_are_nearest_to_the_mean_of_their_group(spark):
    rnd = random.Random(4)
    rows = [(i, [f"{'xyz'[i % 3]}{rnd.randrange(12)}" for _ in range(5)]) for i in range(300)]
    got = cl.kmeans_groups(spark.createDataFrame(rows, "i int, t array<string>"), "t", 50).collect()
    words = sorted({w for _, t in rows for w in t})
    idf = np.log(301 / (1 + np.array([sum(w in t for _, t in rows) for w in words])))
    x = np.array([[r.t.count(w) for w in words] for r in got]) * idf
    groups = sorted({r.group for r in got})
    mine = np.array([groups.index(r.group) for r in got])
    means = np.array([x[mine == g].mean(0) for g in range(len(groups))])
    far = ((x[:, None] - means) ** 2).sum(2)
    assert 2 <= len(groups) <= 6 and (far[np.arange(len(x)), mine] <= far.min(1) + 1e-4).all()

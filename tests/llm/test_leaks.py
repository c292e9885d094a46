import random
import unicodedata

import numpy as np
import pytest

from chatloom.llm import leaks as lk


def plain(t):
    return "".join(c for c in unicodedata.normalize("NFKC", t).lower() if unicodedata.category(c)[0] in "LN")


def shares(a, b, n):
    grams = {b[i : i + n] for i in range(len(b) - n + 1)}
    return any(a[i : i + n] in grams for i in range(len(a) - n + 1))


def test_against_brute_force(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcde，。 中文字АБé１2") for _ in range(rnd.randint(1, 9)))
    items = [(k, "".join(word() for _ in range(40))) for k in range(30)] + [(90, None), (91, ""), (92, "short"), (3, "一二三四五" * 12)]
    docs = [(900, None, 1), (901, "", 1), (902, "一二三四五" * 9, 1), (902, "一二三四五" * 9, 2)]
    for k in range(150):
        _, t = items[rnd.randrange(30)]
        at, n = rnd.randrange(100), rnd.choice([20, 45, 55, 60, 70, 150])
        docs.append((k, word() * 5 + t[at : at + n].upper() + "​" + word() * 5, 1))
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    i = spark.createDataFrame(items, "item_id int, text string")
    want = sorted((a, b) for a, t, _ in docs for b, u in items if t and u and shares(plain(t), plain(u), 40))
    got = sorted((r.doc_id, r.item_id) for r in lk.leaks(d, "doc_id", "text", i, "item_id", "text").collect())
    assert got == want and 20 < len(want) < 150
    assert lk.leaks(d, "doc_id", "text", i.limit(0), "item_id", "text").collect() == []
    assert lk.leaks(d.limit(0), "doc_id", "text", i, "item_id", "text").collect() == []


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lk, "ITEM_BYTES", 200)
    items = [(k, "".join(chr(97 + (k * 7 + j * j) % 26) for j in range(60))) for k in range(6)]
    docs = [(k, "zz" + t) for k, t in items]
    got = {(r.d, r.i) for r in lk.leaks(spark.createDataFrame(docs, "d long, t string"), "d", "t", spark.createDataFrame(items, "i long, t string"), "i", "t").collect()}
    assert {(k, k) for k in range(6)} <= got


@pytest.mark.parametrize("edits", [1, 2])
def test_within_edits(edits):
    rnd = random.Random(edits)
    item = "".join(rnd.choice("abcdefghij") for _ in range(120))
    step, need = lk.stride(40, edits, 8)
    for index, least in ((lk.Items([0], [item], 8), None), (lk.Items([0], [item], 8, step), need)):
        for _ in range(40):
            at = rnd.randrange(60)
            part = list(item[at : at + 50])
            for _ in range(edits):
                k = rnd.randrange(len(part))
                part[k : k + 1] = rnd.choice([[], ["z"], [part[k], "z"]])
            assert lk.find_leaks(index, ["q" * 30 + "".join(part) + "w" * 30], 40, edits, least) == {(0, 0)}
        assert lk.find_leaks(index, ["".join(rnd.choice("abcdefghij") for _ in range(300))], 40, edits, least) == set()


def within(a, b, length, edits):
    """Whether a run of at least ``length`` characters of one text is within ``edits`` edits of a run of the other, by plain recurrence."""
    for x, y in ((a, b), (b, a)):
        for start in range(len(x) - length + 1):
            run = x[start : start + length]
            row = [0] * (len(y) + 1)  # the other run begins anywhere
            for i, c in enumerate(run):
                new = [i + 1]
                for j, e in enumerate(y):
                    new.append(min(row[j] + (c != e), row[j + 1] + 1, new[-1] + 1))
                row = new
            if min(row) <= edits:
                return True
    return False


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_edits_against_brute_force(edits):
    rnd = random.Random(10 + edits)
    length, q = 20, {0: 8, 1: 4, 2: 4}[edits]
    step, need = lk.stride(length, edits, q)
    items = ["".join(rnd.choice("abcd") for _ in range(45)) for _ in range(5)] + ["ab" * 20, "a" * 30]
    index = lk.Items(list(range(len(items))), items, q, step)
    texts = ["a" * 25, "ba" * 14, "a" * 12 + "b" + "a" * 12]
    for _ in range(60):
        at = rnd.randrange(20)
        part = list(rnd.choice(items)[at : at + rnd.randint(16, 26)])
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(part))
            part[k : k + 1] = rnd.choice([[], [rnd.choice("abcd")], [part[k], rnd.choice("abcd")]])
        texts.append("".join(rnd.choice("abcd") for _ in range(8)) + "".join(part) + "".join(rnd.choice("abcd") for _ in range(8)))
    want = {(d, i) for d, t in enumerate(texts) for i, u in enumerate(items) if within(t, u, length, edits)}
    assert lk.find_leaks(index, texts, length, edits, need) == want and 10 < len(want) < len(texts) * len(items)


def test_repeated_grams_stay_bounded(monkeypatch):
    import tracemalloc

    step, need = lk.stride(40, 0, lk.Q)
    assert (step, need) == (8, 3)
    index = lk.Items([0, 1], ["7" * 2000, "x" * 39], lk.Q, step)
    tracemalloc.start()
    assert lk.find_leaks(index, ["7" * 8000, "7" * 39, "7" * 40], 40, 0, need) == {(0, 0), (2, 0)}
    assert lk.find_leaks(lk.Items([0], ["7" * 2000], lk.Q), ["7" * 8000], 40, 0) == {(0, 0)}
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    monkeypatch.setattr(lk, "HITS", 64)
    rnd = random.Random(1)
    items = ["".join(rnd.choice("ab") for _ in range(90)) for _ in range(6)] + ["ab" * 60]
    texts = ["".join(rnd.choice("ab") for _ in range(30)) + items[rnd.randrange(7)][rnd.randrange(40) :][: rnd.choice([39, 40, 45])] for _ in range(40)]
    want = {(d, i) for d, t in enumerate(texts) for i, u in enumerate(items) if shares(t, u, 40)}
    assert lk.find_leaks(lk.Items(list(range(7)), items, 8, 4), texts, 40, 0, 8) == want


def test_aligned():
    a = np.array([[1, 2, 3, 4, 5, 6]], np.int64)
    wide = np.array([[-2, 1, 2, 9, 4, 5, 6, -2]], np.int64)
    assert lk.aligned(a, a, 6, 0, 0)[0] and not lk.aligned(a, a + 1, 3, 0, 0)[0]
    assert lk.aligned(a, wide, 6, 1, 1)[0] and not lk.aligned(a, wide, 6, 0, 1)[0]

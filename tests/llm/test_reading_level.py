import random

import numpy as np
import pytest

from chatloom.llm import reading_level as rl


def test_word_nodes():
    nodes, n = rl.word_nodes(["Ab ab, AB", "", "中文字", "中文 ab", "x" * 5000])
    split = np.split(nodes, np.cumsum(n)[:-1])
    assert list(n) == [1, 0, 2, 2, 1]
    assert set(split[3]) & set(split[0]) == set(split[0]) and len(set(split[3]) & set(split[2])) == 1
    assert rl.word_nodes([])[0].size == 0


def test_borders():
    counts = np.zeros((10, 5))
    for s, level in [(0, 1), (2, 2), (4, 3), (6, 4), (8, 5)]:
        counts[s, level - 1] = 9
    b = rl.borders(counts)
    assert [1 + sum(s >= x for x in b) for s in (0, 2, 4, 6, 8)] == [1, 2, 3, 4, 5]


@pytest.fixture(scope="module")
def made():
    rnd = random.Random(4)
    words = {k: [f"{c}{d}w" for c in "abcdefgh" for d in chr(105 + k) * 3] for k in range(1, 6)}
    docs, ratings = [], []
    for k in range(1500):
        level = rnd.randint(1, 5)
        docs.append((k, " ".join(rnd.choice(words[level] if rnd.random() < 0.7 else words[rnd.randint(1, 5)]) for _ in range(40)), level))
        if k % 3 == 0:
            ratings.append((k, "r1", level))
        if k % 9 == 0:
            ratings.append((k, "r2", min(5, max(1, level + rnd.choice([-1, 0, 1])))))
    return docs, ratings + [(0, "r2", None), (3, "r2", 9), (6, "r1", ratings[2][2]), (None, "r1", 2)]


def test_held_out_accuracy(spark, made):
    docs, ratings = made
    extra = [(9001, None, "s"), (9002, "  　", "s"), (9003, "123 456", "s"), (1, docs[1][1], "again")]
    d = spark.createDataFrame([(k, t, "s") for k, t, _ in docs] + extra, "doc_id long, text string, level string")
    r = spark.createDataFrame(ratings, "doc_id long, rater string, reading_level int")
    got = [(x.doc_id, x.level) for x in rl.reading_levels(d, "doc_id", "text", r, "doc_id", "reading_level", "rater", "r1").collect()]
    assert len(got) == len(docs) + 2 and {k for k, _ in got} >= {9003} and not {9001, 9002} & {k for k, _ in got}
    found, true = dict(got), {k: level for k, _, level in docs}
    unrated = [k for k in true if k % 3]
    assert np.mean([(found[k] >= 4) == (true[k] >= 4) for k in unrated]) > 0.95
    assert np.mean([abs(found[k] - true[k]) <= 1 for k in unrated]) > 0.9


def test_no_ratings_and_no_documents(spark, made):
    d = spark.createDataFrame([(1, "some words", 0)], "doc_id long, text string, score int")
    r = spark.createDataFrame([(1, "r1", None)], "doc_id long, rater string, reading_level int")
    args = ("doc_id", "reading_level", "rater", "r1")
    assert [(x.doc_id, x.score, x.level) for x in rl.reading_levels(d, "doc_id", "text", r, *args).collect()] == [(1, None, None)]
    assert rl.reading_levels(d.limit(0), "doc_id", "text", r, *args).collect() == []

"""Queries registered over the whole job: each case has more than an earlier cut kept."""

import math

import pytest

from chatloom.plans import pair_queries as pq


def write(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_vocabulary_beyond_500_terms(spark, tmp_path):
    # Term i is in i // 100 + 1 rows, so ranks from 500 on have ties.
    rows = [(n, " ".join(f"t{i}" for i in range(700) if i // 100 >= n)) for n in range(7)]
    sf = write(spark, tmp_path, "robot_log", [*rows, (7, None)], "log_id long, segment string")
    got = {r.term: (r.n, r.df, r.idf) for r in pq.QUERIES["vocabulary"](spark, sf).collect()}
    assert got == {f"t{i}": (i // 100 + 1, i // 100 + 1, round(math.log(7 / (i // 100 + 2)), 9)) for i in range(700)}
    weights = {(r.doc, r.term): r.weight for r in pq.QUERIES["tfidf"](spark, sf).collect()}
    assert len(weights) == sum(700 - 100 * n for n in range(7))
    for (doc, term), w in weights.items():
        assert w == pytest.approx(math.log(7 / (int(term[1:]) // 100 + 2)) / (700 - 100 * doc), abs=1e-9)


def test_edit_distance_expression_over_given_pairs(spark, tmp_path):
    pairs = [(i, f"怎么安装{'x' * (i % 4)}手机", "怎么安装手机呢", None, None) for i in range(20)] + [(20, None, "a", None, None), (21, "C的最", "G", "", ""), (22, "", "ab", "", "")]
    sf = write(spark, tmp_path, "sim_cross", pairs, "pair_id long, yestques string, recenques string, yestseg string, recenseg string")
    got = {r.pair_id: r.out for r in pq.QUERIES["edit_distance_expression"](spark, sf).collect()}
    assert got == {r.pair_id: r.out for r in pq.QUERIES["edit_distance"](spark, sf).collect()} and set(got) == set(range(23)) - {20}


def test_filtered_tokens_of_any_language(spark, tmp_path):
    rows = [("Router reset the router", "en"), ("router manual, reset", None), ("manual x9 lonely", "zh"), ("of of", ""), (None, "en")]
    sf = write(spark, tmp_path, "documents", rows, "text string, lang string")
    assert {r.term: r.n for r in pq.QUERIES["filtered_tokens"](spark, sf).collect()} == {"router": 3, "reset": 2, "manual": 2, "of": 2}


def test_bigrams_of_the_log(spark, tmp_path):
    sf = write(spark, tmp_path, "robot_log", [(1, "怎么安装 ab9"), (2, "手"), (3, None), (4, "")], "log_id long, question string")
    got = {r.log_id: r.tokens for r in pq.QUERIES["tokens_bigram"](spark, sf).collect()}
    assert got == {1: ["怎么", "么安", "安装", "ab9"], 2: ["手"], 3: None, 4: []}

import random

import pytest
from pyspark.sql import functions as F

from chatloom.functions import segment, strings
from chatloom.operators import mining as mi

NATURES = {"路由器": "n", "怎么": "r", "怎么办": "v", "路": "n"}


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, q string").orderBy("i")


def test_dictionary_terms(spark):
    df = rows(spark, ["路由器 怎么办", "怎么　走路\n", "", None, "a.b"])
    terms = segment.dictionary_terms(F.col("q"), NATURES, "x")
    got = df.select(segment.with_natures(terms).alias("t"), segment.words_of(segment.without(terms, ["走"], ["x"])).alias("w")).collect()
    assert [r.t for r in got] == ["路由器/n 怎么办/v", "怎么/r 走/x 路/n", "", None, "a/x ./x b/x"]
    assert [r.w for r in got] == [["路由器", "怎么办"], ["怎么", "路"], [], None, []]
    assert [r.t for r in df.select(segment.with_natures(segment.dictionary_terms(F.col("q"), {}), "|", "_").alias("t")).collect()][4] == "a_|._|b_"


def test_one_expression_equals_the_match_by_sets(spark, monkeypatch):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abc中+") for _ in range(rnd.randint(1, 4))) for _ in range(40)]
    df = rows(spark, ["".join(rnd.choice("abc中+ \t　.") for _ in range(rnd.randint(0, 30))) for _ in range(200)] + [None])
    short = [r.t for r in df.select(segment.dictionary_tokens(F.col("q"), words, ["a"]).alias("t")).collect()]
    monkeypatch.setattr(segment, "ALTERNATIVES", 0)
    assert [r.t for r in df.select(segment.dictionary_tokens(F.col("q"), words, ["a"]).alias("t")).collect()] == short


def test_plugged_terms(spark):
    terms = segment.plugged_terms(F.col("q"), lambda: lambda t: [(w, "n" if w.isalpha() else None) for w in t.split()])
    got = rows(spark, ["ab 1", "", None]).select(segment.with_natures(terms).alias("t"), segment.words_of(segment.without(terms, stop_natures=["n"])).alias("w")).collect()
    assert [(r.t, r.w) for r in got] == [("ab/n 1/", ["1"]), ("", []), (None, None)]


def test_first_stop_words(spark):
    df = spark.createDataFrame([(["的", "我", "的", "a"],), ([],), (None,), (["x"],)], "t array<string>")
    assert [r.t for r in df.select(segment.drop_first(F.col("t"), ["的", "我", "不"]).alias("t")).collect()] == [["的", "a"], [], None, ["x"]]
    assert [r.t for r in df.select(segment.only_chinese(segment.drop_first(F.col("t"), ["的", "的"])).alias("t")).collect()] == [["我"], [], None, []]
    assert [r.t for r in df.select(segment.drop_first(F.col("t"), []).alias("t")).collect()][0] == ["的", "我", "的", "a"]


def test_now_and_ratio(spark):
    df = spark.createDataFrame([("auto", "1", "4"), (None, "x", "2"), ("2023-05-01 10:00:00", "3", "0")], "t string, a string, b string")
    got = df.select(strings.get_date(F.col("t")).alias("d"), F.current_date().cast("string").alias("today"), strings.get_time(F.col("t")).alias("at"), mi.double_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert got[0].d == got[0].today and got[0].at.startswith(got[0].today) and got[1].d == "1970-01-01" and got[2].d == "2023-05-01"
    assert [r.r for r in got] == [0.25, None, None]


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_statistics_against_the_library(spark, keys):
    import statistics

    rnd = random.Random(2)
    data = [(rnd.choice(["hot", "hot", "a", None]), rnd.choice([None, 1.0, 2.0, 2.0, -3.5, rnd.random()])) for _ in range(400)] + [("none", None)]
    df = spark.createDataFrame(data, "k string, v double")
    groups = {}
    for k, v in data:
        groups.setdefault(k if keys else 0, []).append(v)
    got = {(r.k if keys else 0): r for r in mi.describe(df, "v", keys).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        v, r = sorted(x for x in values if x is not None), got[k]
        if not v:
            assert (r.mean, r.median, r["mode"], r.std, r.least) == (0.0, 0.0, None, None, None)
            continue
        assert r.mean == pytest.approx(statistics.fmean(v)) and r.median == pytest.approx(statistics.median(v)) and r.variance == pytest.approx(statistics.pvariance(v))
        assert r["mode"] == min(x for x in v if v.count(x) == max(map(v.count, v))) and (r.least, r.greatest) == (v[0], v[-1])

import pytest
from pyspark.sql import functions as F

from chatloom.operators import mining as mi
from chatloom.operators import ranking as ra


def test_itemsets_and_rules(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a", "b", "c"],), (["a"],), (["b", "c"],)], "items array<string>")
    sets, rules = mi.frequent_itemsets(df, "items", 0.5, 0.6)
    assert {tuple(r["items"]): r.freq for r in sets.collect()} == {("a", "b"): 2, ("b", "c"): 2}
    assert {"confidence", "lift"} <= set(rules.columns) and rules.count() > 0


def test_models(spark):
    rows = spark.createDataFrame([("red apple pie", 1.0), ("green apple tart", 1.0), ("fast car race", 0.0), ("slow car ride", 0.0), (None, 0.0)], "text string, label double")
    made = mi.hashed_features(rows, "text", ["pie"], 64)
    assert made.count() == 4 and {"words", "kept", "tf", "features"} <= set(made.columns)
    assert "pie" not in made.where("text like 'red%'").first().kept
    assert mi.logistic_predict(made, made, "label").where("prediction = label").count() == 4
    tokens = spark.createDataFrame([(["a", "b", "c"],)] * 20, "t array<string>")
    assert mi.word_vectors(tokens, "t", 4, 1).findSynonyms("a", 2).count() == 2


def test_vocabulary(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b", ""]), (2, ["a"]), (3, [])], "id int, t array<string>")
    got = {r.term: (r.n, r.df, round(r.idf, 6)) for r in mi.vocabulary(docs, "t").collect()}
    assert got == {"a": (3, 2, 0.0), "b": (1, 1, 0.405465)}
    assert {(r.doc, r.term): round(r.weight, 6) for r in mi.tfidf(docs, "id", "t", mi.vocabulary(docs, "t", 1)).collect()} == {(1, "a"): 0.0, (1, "b"): round(3.76 / 3, 6), (2, "a"): 0.0}


def test_dialogue_pairs(spark):
    rows = [("d", "100", 0, "路由器怎么安装"), ("d", "200", 1, "请先打开电源再连接网线"), ("d", "100", 2, "还是不行的路由器"), ("d", "200", 3, "您试过重启路由器吗"), ("d", "200", 4, "请重启路由器以后再试一次"),
            ("d", "200", 5, "短"), ("d", "200", 6, "第四个回答就不在三个之内了"), ("e", "200", 0, "没有问题的对话里的回答"), ("e", "100", 1, "路由器")]
    chat = spark.createDataFrame(rows, "dialogue string, speaker string, place int, text string")
    none = spark.createDataFrame([], "q string")
    got = {(r.question, r.answer) for r in mi.dialogue_pairs(chat, ["路由器"], none).collect()}
    assert got == {("路由器怎么安装", "请先打开电源再连接网线"), ("路由器怎么安装", "请重启路由器以后再试一次"), ("还是不行的路由器", "请重启路由器以后再试一次")}
    gone = spark.createDataFrame([("路由器怎么安装",)], "q string")
    assert {r.question for r in mi.dialogue_pairs(chat, ["路由器"], gone).collect()} == {"还是不行的路由器"}


def test_hierarchy_and_keywords(spark):
    categories = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", None)], "id string, parent_id string")
    classes = spark.createDataFrame([("1", "c", "k"), ("2", "x", "k"), ("3", "b", "no")], "id string, category_id string, name string")
    words = spark.createDataFrame([("1", "词一"), ("1", "短"[:1]), ("2", "词二"), ("3", "词三")], "class_id string, name string")
    assert [r.name for r in mi.hierarchy_words(categories, classes, words, ["a"], ["no"]).collect()] == ["词一"]
    rows = spark.createDataFrame([("怎么办", ["a", "b", "z"]), ("x", ["a"]), ("一二三四五六七", ["z"]), ("一二", ["z"])], "question string, tokens array<string>")
    weights = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "word string, weight double")
    assert {r.question: (round(r.weight, 6), r.level) for r in mi.keyword_weights(rows, weights).collect()} == {"怎么办": (0.5, 1), "x": (0.9, -1), "一二三四五六七": (0.0, 0), "一二": (0.0, -1)}


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (None,)], "v double")
    r = mi.describe(df, "v").first()
    assert (r.mean, r.median, r["mode"], r.least, r.greatest) == (2.0, 1.0, 1.0, 1.0, 4.0) and r.variance == pytest.approx(2.0) and r.std == pytest.approx(2**0.5)
    assert mi.describe(df.limit(0), "v").first().mean == 0.0


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.9), ("a", 3, 0.9), ("b", 4, 0.1)], "k string, i int, s double")
    assert {(r.k, r.i, r["rank"], r["size"]) for r in ra.ranked_with_size(df, ["k"], [F.desc("s"), F.col("i")], 2).collect()} == {("a", 2, 1, 2), ("a", 3, 2, 2), ("b", 4, 1, 1)}
    assert [r.n for r in ra.numbered(df, ["i"], "n").orderBy("i").collect()] == [0, 1, 2, 3]
    assert ra.numbered(df.limit(0), ["i"], "n").collect() == []
    line = spark.createDataFrame([("__label__a_sp_b 0.7 __label__c 0.3", "q\tx\t0.5,f|0.25,g,h")], "a string, b string")
    assert [tuple(x) for x in line.select(ra.parse_labels(F.col("a"))).first()[0]] == [("a b", 0.7), ("c", 0.3)]
    q, parts = ra.parse_ranked_line(F.col("b"))
    got = line.select(q.alias("q"), parts.alias("p")).first()
    assert got.q == "q" and [(x.faq, x.score) for x in got.p] == [("f", 0.5), ("g,h", 0.25)]
    members = spark.createDataFrame([("g", 0, "x"), ("g", 0, "y"), ("g", 1, "z")], "group string, cluster int, text string")
    weights = spark.createDataFrame([("y", 2.0)], "text string, weight double")
    assert {(r.cluster, r.text, r.weight) for r in ra.best_of_cluster(members, weights).collect()} == {(0, "y", 2.0), (1, "z", 0.0)}
    assert ra.require_rows(df) is df
    with pytest.raises(ValueError):
        ra.require_rows(df.limit(1))

import dataclasses

import pytest
from pyspark.sql import functions as F

from chatloom.operators import ranking as ra
from chatloom.operators import sessions as se
from chatloom.plans import jobs
from chatloom.sources import tables as so

FIELDS = "log_id bigint, loaded_at timestamp, " + ", ".join(f"{f} string" for f in so.FIELDS)


def log(spark, rows):
    made = []
    for k, r in enumerate(rows):
        base = dict.fromkeys(so.FIELDS) | {"visit_time": f"2023-05-30 10:{k % 60:02d}:00", "session_id": "s", "ex": "", "answer_type": "1"} | r
        made.append((k, None, *(base[f] for f in so.FIELDS)))
    return spark.createDataFrame(made, FIELDS)


def test_mining_with_words_and_answers(spark):
    said = [("路由器怎么安装呢请问", "请先打开电源再连接网线就行"), ("路由器怎么安装呢请教", "请先打开电源再连接网线就好"), ("耳机坏了怎么修理啊", "请把耳机送到附近的服务网点")]
    rows = log(spark, [{"session_id": f"s{k}", "question": q, "answer": a} for k, (q, a) in enumerate(said)])
    t = lambda data, schema: spark.createDataFrame(data, schema)
    config = jobs.JobConfig(ref="2023-05-30", tables={
        "categories": t([("c", None), ("d", "c")], "id string, parent_id string"), "classes": t([("1", "d", "devices"), ("2", "x", "other")], "id string, category_id string, name string"),
        "words": t([("1", "路由器"), ("2", "耳机")], "class_id string, name string"), "roots": t([("c",)], "id string"),
    })
    assert [r.name for r in jobs.run_job("words", spark, rows, config)["words"].collect()] == ["路由器"]
    out = jobs.run_job("mining", spark, rows, config)
    assert {r.question for r in out["pairs"].collect()} == {said[0][0], said[1][0]}
    assert out["clusters"].select("id").distinct().count() == 1
    assert {(r.cluster, r.weight, r.answer) for r in out["answers"].collect()} == {(0, 1.0, said[0][1]), (0, 1.0, said[1][1])}
    domain = jobs.run_job("mining", spark, rows, dataclasses.replace(config, tables={}, domain=["耳机"]))
    assert {r.question for r in domain["pairs"].collect()} == {said[2][0]}


def test_import_with_labels(spark):
    rows = log(spark, [{"question": "怎么安装"}, {"question": "怎么安装", "visit_time": "2023-05-30 10:00:00"}, {"question": None}, {"question": "无标签"}])
    labels = spark.createDataFrame([("怎么安装", "7"), ("", "9")], "cleaned string, label string")
    out = jobs.run_job("import", spark, rows, jobs.JobConfig(tables={"labels": labels}))
    assert sorted((r.log_id, r.label) for r in out["labelled"].collect()) == [(0, "7"), (2, "0")]
    assert "labelled" not in jobs.run_job("import", spark, rows, jobs.JobConfig())


def test_clean_job(spark):
    rows = log(spark, [{"question": "怎么安装"}, {"question": "怎么安装 "}, {"question": "安装"}, {"question": "english"}, {"question": "哈哈哈哈哈"}, {"question": None}])
    assert [(r.question, r.number) for r in jobs.run_job("clean", spark, rows, jobs.JobConfig())["questions"].orderBy("number").collect()] == [("安装", 0), ("怎么安装", 1)]


def test_handoff_scores(spark):
    df = spark.createDataFrame([("a", 1, "2023-05-30"), ("a", 4, "2023-05-27"), ("b", 0, "2023-05-20"), ("c", 30, "2023-05-30"), ("d", 11, "2023-01-01")], "question string, distance int, day string").withColumn("day", F.to_date("day"))
    assert {r.question: (r.score, r.level) for r in se.handoff_scores(df, "2023-05-30").collect()} == {"a": (60, 3), "b": (11, 0), "c": (21, 1), "d": (2, 0)}


def test_unite_labels(spark):
    lines = spark.createDataFrame([("c1\tx\t__label__a_sp_b 0.5 __label__c 0.25",), ("c1\t__label__c 0.5",), ("c2\t",)], "line string")
    ids = spark.createDataFrame([("c", "9")], "faq_name string, latest_id string")
    assert [(r.cluster, r.faq, r.score, r["rank"], r["size"], r.faq_id) for r in ra.unite_labels(lines, "line", ids).orderBy("rank").collect()] == [("c1", "c", 0.75, 1, 2, "9"), ("c1", "a b", 0.5, 2, 2, "")]
    assert {r.faq: r.score for r in ra.unite_labels(lines, "line", ids, with_scores=False).collect()} == {"c": 2.0, "a b": 1.0}


@pytest.mark.parametrize("salts", [1, 64])
def test_samples_per_key(spark, monkeypatch, salts):
    monkeypatch.setattr(ra, "SALTS", salts)
    rows = [("hot", f"q{k % 90:02d}") for k in range(1000)] + [("cold", "x"), ("cold", "y"), (None, "z")]
    df = spark.createDataFrame(rows, "k string, v string")
    got = [(r.k, r.v, r.n, r.total, r["rank"]) for r in ra.samples_per_key(df, "k", "v", 3, 50).collect()]
    hot = sorted(((f"q{k:02d}", 12 if k < 10 else 11) for k in range(90)), key=lambda p: (-p[1], p[0]))[:23]
    assert sorted(got, key=repr) == sorted([("hot", v, n, 1000, i + 1) for i, (v, n) in enumerate(hot)] + [("cold", "x", 1, 2, 1), ("cold", "y", 1, 2, 2), (None, "z", 1, 1, 1)], key=repr)


def test_robot_answers(spark):
    assert so.parse_robot_answer("<A><Type> 11 </Type><Content>" + "x" * 60 + "</Content></A>") == (11, "x" * 50)
    assert so.parse_robot_answer("<A><Type>0</Type><Content/></A>") == (0, "")
    with pytest.raises(ValueError):
        so.parse_robot_answer("<A><Content>x</Content></A>")
    assert so.robot_address("http://h/?q=[Q]", "[Q]", "a  b 中") == "http://h/?q=a%2Cb%2C%E4%B8%AD"
    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "bb"), (4, None)], "id int, q string")
    ask = lambda q: (1, "" if q == "a" else "yes")
    assert sorted(r.id for r in so.ask_robot(df, "q", ask, [1], at_once=2).collect()) == [1, 4]
    assert [(r.id, r.robot_answer) for r in so.ask_robot(df, "q", ask, [1], True).orderBy("id").collect()] == [(2, "yes"), (3, "yes")]


def test_mined_pairs_need_no_clusters(spark, monkeypatch):
    rows = log(spark, [{"question": "路由器怎么安装呢请问", "answer": "请先打开电源再连接网线就行"}])
    made = []
    monkeypatch.setattr(jobs.cl, "density_clusters", lambda df, group, text: made.append(text) or df.select(F.col(group).alias("group"), F.lit(0).alias("cluster"), F.col(text).alias("text"), F.lit(1).alias("flag")))
    out = jobs.run_job("mining", spark, rows, jobs.JobConfig(ref="2023-05-30", domain=["路由器"]))
    assert out["pairs"].count() == 1 and made == []
    assert out["weights"].count() == 1 == out["clusters"].count() and made == ["question"]  # once for both
    assert len(out.items()) == len(out.values()) == 4 and made == ["question", "plain"]


def test_mined_answers_are_clustered_once(spark):
    rows = log(spark, [{"question": "路由器怎么安装呢请问", "answer": "请先打开电源再连接网线就行"}])
    out = jobs.run_job("mining", spark, rows, jobs.JobConfig(ref="2023-05-30", domain=["路由器"]))["answers"]
    assert out.count() == 1
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()  # each use would make the clusters anew

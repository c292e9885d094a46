import pytest
from pyspark.sql import functions as F

from chatloom.sources import tables as so


def test_text_sources(spark, tmp_path):
    (tmp_path / "log.txt").write_text("2023-05-01 10:00:00|s|u|q|0|a|1|f|n|||b|0.5|m|web|x|c|q|q|1\nshort|line\n", encoding="utf-8")
    rows = so.read_log(spark, str(tmp_path / "log.txt")).collect()
    assert len(rows) == 2 and rows[0].platform == "web" and rows[1].session_id == "line" and rows[1].ex is None
    checked = so.load_log_checked(spark, str(tmp_path / "log.txt")).select("reason", "question").collect()
    assert sorted((r.reason or "", r.question or "") for r in checked) == [("", "q"), ("column_count", "")]
    typed = so.typed_log(so.read_log(spark, str(tmp_path / "log.txt"))).first()
    assert typed.answer_type == 1 and typed.similarity == 0.5 and typed.visit_time.hour == 10
    (tmp_path / "head.csv").write_text("time,model_id\n2023,7\n")
    assert so.read_csv_with_header(spark, str(tmp_path / "head.csv")).first().model_id == "7"
    assert so.read_headless_csv(spark, str(tmp_path / "head.csv"), "a string, b string", ",").count() == 2
    (tmp_path / "list.txt").write_text("B\n\n b \nb\n")
    assert [r.value for r in so.read_list(spark, str(tmp_path / "list.txt"), lower=True).collect()] == ["b"]
    assert so.read_whole_files(spark, str(tmp_path / "list.txt")).first().content == "B\n\n b \nb\n"
    assert so.read_lines(spark, str(tmp_path / "list.txt")).count() == 4
    so.write_local(["x", "y"], str(tmp_path / "out.txt"))
    assert (tmp_path / "out.txt").read_text() == "x\ny\n"


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "2023-05-01 00:00:00"), (2, "b", "2023-05-01 10:00:00")], "a int, b string, t string")
    so.write_parquet(df, f"{tmp_path}/p")
    assert so.read_parquet(spark, f"{tmp_path}/p").count() == 2
    so.write_delimited(df, f"{tmp_path}/d")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/d").collect()) == ["1||2023-05-01 00:00:00", "2|b|2023-05-01 10:00:00"]
    assert sorted((r.a, r.day) for r in so.by_day(df, "t", inclusive=True).collect()) == [(1, "2023-04-30"), (1, "2023-05-01"), (2, "2023-05-01")]
    so.replace_partitions(so.by_day(df, "t"), f"{tmp_path}/days", "day")
    so.replace_partitions(df.limit(1).withColumn("day", F.lit("2023-05-02")), f"{tmp_path}/days", "day")
    so.replace_partitions(df.withColumn("day", F.lit("2023-05-02")), f"{tmp_path}/days", "day")
    assert {str(r.day): r["count"] for r in spark.read.parquet(f"{tmp_path}/days").groupBy("day").count().collect()} == {"2023-05-01": 2, "2023-05-02": 2}
    assert so.path_exists(spark, f"{tmp_path}/days") and so.backup_path(spark, f"{tmp_path}/days", "old") and not so.path_exists(spark, f"{tmp_path}/days")
    assert so.remove_path(spark, f"{tmp_path}/days_old") and not so.remove_path(spark, f"{tmp_path}/days_old") and so.make_path(spark, f"{tmp_path}/new")


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "a.ini").write_text("[s]\nKey = v%1\n")
    (tmp_path / "a.properties").write_text('# c\nk="v"\nx = 1\n')
    assert so.read_ini(str(tmp_path / "a.ini")) == {"s": {"Key": "v%1"}} and so.read_properties(str(tmp_path / "a.properties")) == {"k": "v", "x": "1"}
    monkeypatch.setenv("CHATLOOM_JDBC_URL", "jdbc:x")
    assert so.jdbc_options() == {"url": "jdbc:x"}


def test_jdbc(spark):
    options = {"url": "jdbc:derby:memory:chatloom;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    months = [("MONTH202304", "2023-04-30 10:00:00"), ("MONTH202305", "2023-05-01 00:00:00"), ("MONTH202305", "2023-05-09 10:00:00")]
    try:
        so.execute_jdbc(spark, options, [f"create table {name} (ID int, SLDAT varchar(30))" for name in ("MONTH202304", "MONTH202305")])
    except Exception as e:  # no Derby driver on this class path
        pytest.skip(str(e)[:80])
    for name in ("MONTH202304", "MONTH202305"):
        for mode in ("append", "overwrite"):
            so.write_jdbc(spark.createDataFrame([(i, t) for i, (n, t) in enumerate(months) if n == name], "ID int, SLDAT string"), name, options, mode)
    assert so.read_jdbc(spark, "MONTH202305", options).count() == 2
    assert so.read_jdbc(spark, "MONTH202305", options, ("ID", 0, 9, 2)).count() == 2
    assert sorted(r.ID for r in so.read_months(spark, "MONTH", "2023-04-30", "2023-05-01", options, "SLDAT").collect()) == [0, 1]
    so.write_jdbc(spark.createDataFrame([(7, "x")], "ID int, SLDAT string"), "MONTH202305", options)
    assert so.read_settings(spark, "MONTH202305", options)[7] == "x"
    assert so.execute_jdbc(spark, options, ["delete from MONTH202305 where ID = 7", "update MONTH202305 set SLDAT = 'y'"]) == 3
    with pytest.raises(Exception):
        so.execute_jdbc(spark, options, ["delete from MONTH202305", "no statement"])
    assert so.read_jdbc(spark, "MONTH202305", options).count() == 2


def test_small_operators(spark):
    log = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "zz")], "id int, k string")
    labels = spark.createDataFrame([("a", "5"), ("", "9")], "k string, label string")
    assert sorted((r.id, r.label) for r in so.merge_labels(log, labels, "k", "label").collect()) == [(1, "5"), (2, "0"), (3, "0")]
    assert sorted((r.id, r.alias) for r in so.aliases(log, labels.withColumnRenamed("label", "alias"), "k").collect()) == [(1, "5"), (2, ""), (3, ""), (4, "")]
    ask = lambda q: (1, "long " * 30) if q == "a" else (0, "none")
    assert [r.id for r in so.ask_robot(log, "k", ask, [1], keep_answered=True).collect()] == [1]
    assert len(so.ask_robot(log, "k", ask, [1]).collect()) == 3

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from chatloom.plans import jobs
from chatloom.plans.job_queries import CONFIG
from chatloom.streaming import counts

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and len(names) > 100


def test_works_without_the_llm_folder(tmp_path):
    for name in ("chatloom", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{ROOT}/{name}", tmp_path], check=True)
    subprocess.run(["rm", "-rf", tmp_path / "chatloom/llm"], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p1_found' not in q and set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)


def test_nothing_else_imports_the_llm_folder():
    for folder, _, files in os.walk(f"{ROOT}/chatloom"):
        if not folder.endswith("llm"):
            for f in files:
                if f.endswith(".py"):
                    with open(f"{folder}/{f}", encoding="utf-8") as text:
                        assert "chatloom.llm" not in text.read(), f


@here
def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"day", "cnt0", "cnt11", "n_questions"}


@here
def test_jobs(spark, tmp_path):
    log = spark.read.parquet(f"{SF}/robot_log.parquet")
    with pytest.raises(ValueError):
        jobs.run_job("none", spark, log, CONFIG)
    out = jobs.run_job("mapping", spark, log, CONFIG, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/mapping/questions").count() == out["questions"].count() > 0
    for name in ("unanswered", "sessions", "semantic", "training"):
        for df in jobs.run_job(name, spark, log.limit(0), CONFIG).values():
            assert df.collect() == []


@here
def test_stream_drops_late_rows(spark, tmp_path):
    schema = "visit_time string, answer_type string"
    made = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    made([("2023-05-01 10:00:00", "0"), ("2023-05-01 10:30:00", "11"), ("bad", "0")])
    rows = counts.windowed_types(counts.log_stream(spark, f"{tmp_path}/in", spark.read.schema(schema).parquet(f"{tmp_path}/in").schema), "1 hour", "1 hour")
    query = rows.writeStream.outputMode("append").format("memory").queryName("late_rows").option("checkpointLocation", f"{tmp_path}/state").start()
    query.processAllAvailable()
    made([("2023-05-02 10:00:00", "1")])
    query.processAllAvailable()
    made([("2023-05-01 10:10:00", "0"), ("2023-05-03 10:00:00", "1")])
    query.processAllAvailable()
    query.stop()
    got = {str(r.start): (r.n, r.cnt0, r.cnt11) for r in spark.table("late_rows").collect()}
    assert got["2023-05-01 10:00:00"] == (2, 1, 1)

import json
import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

QUERIES = ["jdbc_scan", "jdbc_append", "jdbc_settings", "jdbc_statements", "jdbc_months", "jdbc_batches"]
SCRIPT = """
import json, sys
from pyspark.sql import SparkSession
import __spark_entry__
from chatloom.sources import tables as so
so.EMBEDDED_ROWS = 333
folder, data, names = sys.argv[1], sys.argv[2], sys.argv[3:]
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{folder}/shared").config("spark.sql.session.timeZone", "UTC").config("spark.driver.host", "127.0.0.1").getOrCreate()
out = {}
for name in names:
    try:
        df = __spark_entry__.queries()[name](spark, data)
        out[name] = [df.columns, [[str(v) for v in r] for r in df.collect()]]
    except Exception as e:
        out[name] = str(e)[:300]
print("\\n" + json.dumps(out), flush=True)
spark.stop()
"""


@pytest.fixture(scope="module")
def found(tmp_path_factory):
    """The queries' rows on two executors outside the driver's process, which share no database in memory."""
    folder = tmp_path_factory.mktemp("cluster")
    (folder / "home/work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():  # the executors' logs go to work in Spark's home
        if p.name != "work":
            (folder / "home" / p.name).symlink_to(p)
    root = str(Path(__file__).resolve().parent.parent)
    env = os.environ | {"SPARK_HOME": str(folder / "home"), "PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}", "PYSPARK_PYTHON": sys.executable, "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, str(folder), "/root/testdata/sf0.01", *QUERIES], env=env, cwd=folder, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    return json.loads(run.stdout.strip().splitlines()[-1])


@pytest.mark.parametrize("name", QUERIES)
def test_executors_outside_the_driver(found, name):
    import duckdb

    import __spark_entry__

    assert not isinstance(found[name], str), found[name]
    con = duckdb.connect()
    for t in ("supplier", "nation", "retail_action"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    columns, rows = found[name]
    want = con.execute(f"select {', '.join(columns)} from ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(rows) == sorted([str(v) for v in r] for r in want) and rows

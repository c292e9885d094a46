"""Readers, writers and file operations as queries: whole tables on a round trip through a format, compared with the table itself.

The database queries use an embedded Derby, which lives in the driver's JVM; where the executors don't share it, rows pass the driver."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import strings
from chatloom.operators import ranking as ra
from chatloom.plans import jobs
from chatloom.runtime import local_path, materialize, scratch_path, table
from chatloom.sources import tables as so
from chatloom.sources.rejects import FIELDS
from chatloom.sources.rejects import SQL as REJECTED

SUPPLIER = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
QUERIES, SQL = {}, {}


def _add(name: str, f, sql: str) -> None:
    QUERIES[name], SQL[name] = f, sql


def _supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(*SUPPLIER)


def _lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "robot_log_raw").select("line").write.text(path)
    return path


def pipe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return so.read_log(spark, _lines(spark, sf_dir))


def checked_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by their reason of failure, through the text reader."""
    return so.load_log_checked(spark, _lines(spark, sf_dir)).groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return so.read_lines(spark, _lines(spark, sf_dir)).groupBy("value").agg(F.count("*").alias("n"))


def headless_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch_path(spark, "csv"), _supplier(spark, sf_dir)
    rows.write.csv(path, sep="|")
    return so.read_headless_csv(spark, path, rows.schema.simpleString()[len("struct<") : -1].replace(":", " "))


def csv_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    _supplier(spark, sf_dir).write.csv(path, header=True)
    return so.read_csv_with_header(spark, path).select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", F.col("s_acctbal").cast("double").alias("s_acctbal"))


def whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item as a file of its own."""
    path = scratch_path(spark, "files")
    table(spark, sf_dir, "eval_items").select("item_id", "text").write.partitionBy("item_id").text(path)
    return so.read_whole_files(spark, f"{path}/*").select(F.regexp_extract("path", "item_id=([0-9]+)", 1).cast("long").alias("item_id"), "content")


def parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    so.write_parquet(table(spark, sf_dir, "sim_cross"), path)
    return so.read_parquet(spark, path).select("pair_id", "yestques", "recenques")


def delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    so.write_delimited(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), path)
    return so.read_lines(spark, path)


def small_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "list")
    table(spark, sf_dir, "std_question").select("question").write.text(path)
    return so.read_list(spark, path, lower=True)


def day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log by day; the days of May's second half are loaded twice and stay as they are."""
    path = scratch_path(spark, "days")
    rows = so.by_day(table(spark, sf_dir, "robot_log").select("log_id", "visit_time"), "visit_time")
    so.replace_partitions(rows, path, "day")
    so.replace_partitions(rows.where("day >= '2023-05-16'"), path, "day")
    return spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.sum("log_id").alias("ids"))


def csv_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = scratch_path(spark, "shop"), scratch_path(spark, "shop-days")
    table(spark, sf_dir, "retail_action").select("uid", "sldat", "bndno", "qty").write.csv(source, header=True)
    so.import_csv(spark, source, "2023-01-02", "2023-05-20 23:59:59", "sldat", ["bndno", "qty"], path)
    return spark.read.parquet(path).select("uid", "bndno", "qty", F.col("day").cast("string").alias("day"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make, back up and remove a folder: each step with what it said and whether the folder is there afterwards."""
    path = scratch_path(spark, "folder")
    steps = [("made", lambda: so.make_path(spark, path), path), ("backed up", lambda: so.backup_path(spark, path, "old"), path), ("moved", lambda: so.path_exists(spark, f"{path}_old"), f"{path}_old"),
             ("removed", lambda: so.remove_path(spark, f"{path}_old"), f"{path}_old"), ("removed again", lambda: so.remove_path(spark, f"{path}_old"), f"{path}_old")]
    return spark.createDataFrame([(name, do(), so.path_exists(spark, p)) for name, do, p in steps], "step string, said boolean, there boolean")


def driver_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list and settings files in the shared folder, where the driver mounts it: written, and read again."""
    path = local_path(scratch_path(spark, "settings"))
    os.makedirs(path)
    names = [r.n_name for r in table(spark, sf_dir, "nation").select("n_name").orderBy("n_name").collect()]  # 25 rows
    so.write_local([f'{n} = "{len(n)}"' for n in names], f"{path}/a.properties")
    so.write_local(["[names]", *(f"{n}={len(n) + 1}" for n in names)], f"{path}/a.ini")
    props, ini = so.read_properties(f"{path}/a.properties"), so.read_ini(f"{path}/a.ini")["names"]
    return spark.createDataFrame([(n, props[n], ini[n]) for n in names], "name string, property string, setting string")


def robot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions the robot can't answer. Its place takes a function that answers in the robot's XML by the question's length."""

    def ask(question: str) -> tuple[int, str]:
        return so.parse_robot_answer(f"<Answer><Type>{len(question) % 3}</Type><Content>{'x' * (len(question) % 4 * 30)}</Content></Answer>")

    asked = table(spark, sf_dir, "robot_log").select("question").distinct()
    return so.ask_robot(asked, "question", ask, [1])


def _derby(use):
    """A query over a database of its own, in a folder of the driver (its heap may be smaller), which is removed once the result is written."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = tempfile.mkdtemp(prefix="chatloom-derby-")
        url, driver = f"jdbc:derby:{folder}/db", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
        try:
            out = materialize(use(spark, sf_dir, {"url": f"{url};create=true", **driver}), "database")
            try:
                so.execute_jdbc(spark, {"url": f"{url};shutdown=true", **driver}, [])
            except Exception as e:  # Derby tells of a closed database by an error
                if "shutdown" not in str(e):
                    raise
        finally:
            shutil.rmtree(folder, ignore_errors=True)
        return out

    return run


def _jdbc_scan(spark, sf_dir, o):
    so.write_jdbc(_supplier(spark, sf_dir), "supplier", o, "overwrite")
    return so.read_jdbc(spark, "supplier", o, ("s_suppkey", 1, 1000, 4))


def _jdbc_append(spark, sf_dir, o):
    for mode in ("overwrite", "overwrite", "append"):
        so.write_jdbc(_supplier(spark, sf_dir), "supplier", o, mode)
    return so.read_jdbc(spark, "(select \"s_nationkey\" as k, count(*) as n from supplier group by \"s_nationkey\") t", o).select(F.col("K").alias("k"), F.col("N").cast("long").alias("n"))


def _jdbc_settings(spark, sf_dir, o):
    so.write_jdbc(table(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").cast("string").alias("region")), "settings", o, "overwrite")
    return spark.createDataFrame(list(so.read_settings(spark, "settings", o).items()), "name string, region string")


def _jdbc_statements(spark, sf_dir, o):
    so.write_jdbc(_supplier(spark, sf_dir), "supplier", o, "overwrite")
    so.execute_jdbc(spark, o, ["delete from supplier where \"s_nationkey\" < 5", "update supplier set \"s_acctbal\" = 0 where \"s_nationkey\" > 20"])
    try:
        so.execute_jdbc(spark, o, ["delete from supplier", "no statement"])  # rolled back as a whole
    except Exception:
        pass
    return so.read_jdbc(spark, "supplier", o)


def _jdbc_months(spark, sf_dir, o):
    rows = table(spark, sf_dir, "retail_action").where("sldat is not null").select("uid", "sldat", F.replace(F.substring("sldat", 1, 7), F.lit("-"), F.lit("")).alias("month"))
    for month in sorted(r.month for r in rows.select("month").distinct().collect()):
        so.write_jdbc(rows.where(F.col("month") == month).drop("month"), f"sold{month}", o | {"createTableColumnTypes": "sldat VARCHAR(19)"}, "overwrite")
    path = scratch_path(spark, "months")
    so.import_months(spark, "sold", "2023-04-10", "2023-05-20", o, "sldat", path)
    return spark.read.parquet(path).select("uid", "sldat", F.col("day").cast("string").alias("day"))


def _jdbc_batches(spark, sf_dir, o):
    """A batch loaded twice and another one beside it."""
    rows = _supplier(spark, sf_dir)
    for batch, part in (("a", rows.where("s_nationkey < 20")), ("b", rows), ("a", rows.where("s_nationkey < 10"))):
        jobs.load_results({"supplied": part}, batch, o)
    return so.read_jdbc(spark, "supplied", o).groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("s_suppkey").alias("keys"))


_S = "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier"
_add("source_pipe_log", pipe_log, "select " + ", ".join(f"nullif(p[{i + 1}], '') as {f}" for i, f in enumerate(FIELDS)) + " from (select string_split(line, '|') as p from robot_log_raw where line <> '')")
_add("source_checked_log", checked_log, REJECTED["p7_found"].replace("select line_id, reason from r where reason is not null", "select coalesce(reason, 'good') as reason, count(*) as n from r group by 1"))
_add("source_lines", text_lines, "select coalesce(line, '') as value, count(*) as n from robot_log_raw group by 1")
_add("source_headless_csv", headless_csv, _S)
_add("source_csv_with_header", csv_with_header, "select s_suppkey, s_name, s_acctbal from supplier")
_add("source_whole_files", whole_files, "select item_id, text || chr(10) as content from eval_items")
_add("source_parquet", parquet, "select pair_id, yestques, recenques from sim_cross")
_add("sink_delimited", delimited, "select s_suppkey || '|' || s_name || '|' || s_nationkey as value from supplier")
_add("source_list", small_list, "select distinct lower(trim(question)) as value from std_question where trim(question) <> ''")
_add("sink_day_partitions", day_partitions, "select substr(visit_time, 1, 10) as day, count(*) as n, sum(log_id)::bigint as ids from robot_log where visit_time is not null group by 1")
_add("import_csv", csv_import, "select uid, coalesce(bndno, '0') as bndno, coalesce(qty, '0') as qty, substr(sldat, 1, 10) as day from retail_action where sldat >= '2023-01-02' and sldat <= '2023-05-20 23:59:59'")
_add("file_steps", files, "select * from (values ('made', true, true), ('backed up', true, false), ('moved', true, true), ('removed', true, false), ('removed again', false, false)) t(step, said, there)")
_add("settings_files", driver_files, "select n_name as name, length(n_name)::varchar as property, (length(n_name) + 1)::varchar as setting from nation")
_add("robot_filter", robot, "select question, case when question is not null then repeat('x', least(50, length(question) % 4 * 30)) end as robot_answer from (select distinct question from robot_log) where not coalesce(length(question) % 3 = 1 and length(question) % 4 > 0, false)")
_add("jdbc_scan", _derby(_jdbc_scan), _S)
_add("jdbc_append", _derby(_jdbc_append), "select s_nationkey as k, 2 * count(*) as n from supplier group by 1")
_add("jdbc_settings", _derby(_jdbc_settings), "select n_name as name, n_regionkey::varchar as region from nation")
_add("jdbc_statements", _derby(_jdbc_statements), "select s_suppkey, s_name, s_nationkey, case when s_nationkey > 20 then 0 else s_acctbal end as s_acctbal from supplier where s_nationkey >= 5")
_add("jdbc_months", _derby(_jdbc_months), """select uid, sldat, unnest(case when substr(sldat, 12) = '00:00:00' then [substr(sldat, 1, 10), strftime(substr(sldat, 1, 10)::date - 1, '%Y-%m-%d')] else [substr(sldat, 1, 10)] end) as day
  from retail_action where sldat >= '2023-04-10' and sldat <= '2023-05-20 23:59:59'""")  # fmt: skip
_add("jdbc_batches", _derby(_jdbc_batches), "select 'a' as batch_id, count(*) as n, sum(s_suppkey)::bigint as keys from supplier where s_nationkey < 10 union all select 'b', count(*), sum(s_suppkey)::bigint from supplier")
_add("required_rows", lambda s, d: ra.require_rows(table(s, d, "region").select("r_regionkey", "r_name")), "select r_regionkey, r_name from region")
_add("uuids", lambda s, d: table(s, d, "supplier").select(strings.uuid().alias("u")).agg(F.count("*").alias("n"), F.count_distinct("u").alias("n_distinct"), F.bool_and(F.col("u").rlike("^[0-9a-f]{32}$")).alias("plain")), "select count(*) as n, count(*) as n_distinct, true as plain from supplier")

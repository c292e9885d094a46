"""Problem 2: per-key results when a few keys hold most rows.

Multi-level tree aggregation: rows are combined in fixed-size chunks of the input where they lie, and the partial states are merged in
rounds of fan-in ``FAN_IN``, as many as the counted chunks ask for; no reducer ever receives all rows or all partials of a key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import materialize, table

#: Input rows combined into one state per key before anything is exchanged.
CHUNK_ROWS = 1 << 16
#: States of a key merged by one task in a round.
FAN_IN = 16


def rounds(chunks: int) -> int:
    """Rounds after which at most ``FAN_IN`` states of a key are left."""
    return max(0, math.ceil(math.log(max(chunks, 1), FAN_IN) - 1e-9) - 1)


def _merged(states: DataFrame, chunks: int, merge: list) -> DataFrame:
    """The states of (_key, _chunk), chunk numbers below ``chunks``, merged by neighbouring chunks down to one for each key."""
    for _ in range(rounds(chunks)):
        states = states.groupBy("_key", F.expr(f"_chunk div {FAN_IN}").alias("_chunk")).agg(*merge)
    return states.groupBy("_key").agg(*merge)


def _states(df: DataFrame, key: str, latest: list[str] | None = None, keep: list[str] | None = None) -> tuple[DataFrame, int, list]:
    """Level 0, written: one state per key and chunk; how many chunk numbers there are; the aggregates that merge states."""
    src = df.select(F.col(key).alias("_key"), *([F.struct(*latest, *(keep or [])).alias("_latest")] if latest else []))
    # The identifier holds the partition in its upper bits and the row's place in it in its lower 33.
    place = F.monotonically_increasing_id()
    parts = [F.shiftright(place, 33).alias("_part"), F.expr("_place div " + str(CHUNK_ROWS)).alias("_nth")]
    numbered = src.withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1))).select("*", *parts)
    level = numbered.groupBy("_key", "_part", "_nth").agg(F.count("*").alias("n_rows"), *([F.max("_latest").alias("latest")] if latest else []))
    level = materialize(level, "p2-states")
    last = level.agg(F.max("_part").alias("part"), F.max("_nth").alias("nth")).first()
    # Chunks of a partition follow one another, and each partition takes a power of the fan-in, so that neighbours meet first.
    width = 1 if last.nth is None else FAN_IN ** math.ceil(math.log(last.nth + 1, FAN_IN) - 1e-9)
    merge = [F.sum("n_rows").alias("n_rows"), *([F.max("latest").alias("latest")] if latest else [])]
    dense = level.withColumn("_chunk", F.col("_part") * F.lit(width) + F.col("_nth")).drop("_part", "_nth")
    return dense, width * ((last.part or 0) + 1), merge


def per_key(df: DataFrame, key: str, distinct: str | None = None, latest: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows, distinct values and latest row of every key, without a hot reducer.

    Columns: ``key``, ``n_rows``; ``n_distinct`` of column ``distinct`` (nulls don't count) if given; ``latest``, a struct of ``latest`` and
    ``keep`` columns of the row with the greatest ``latest`` tuple (compared column by column, null smallest; equal tuples are told apart by
    the ``keep`` columns), if given. A null key is a key of its own and comes out with key null. Other columns are ignored, whatever their
    names. Empty input gives no rows.

    Level 0 runs within each chunk of ``CHUNK_ROWS`` input rows as Spark's partial aggregation; the chunk number is part of the key, so that
    one key's rows spread over as many reducers as it has chunks. Distinct values are first made distinct by (key, value), where a hot key
    is spread by its values; each of the tasks that holds them counts its own, and the counts go through the same tree."""
    out = _merged(*_states(df, key, latest, keep))
    if distinct:
        src = df.select(F.col(key).alias("_key"), F.col(distinct).alias("_value"))
        values = src.where("_value is not null").groupBy("_key", "_value").agg(F.lit(1).alias("_one"))
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # what the distinct step's tasks are at most
        counts = values.groupBy("_key", F.spark_partition_id().cast("long").alias("_chunk")).agg(F.count("*").alias("n_distinct"))
        counted = _merged(counts, parts, [F.sum("n_distinct").alias("n_distinct")]).withColumnRenamed("_key", "_other")
        out = out.join(counted, F.col("_key").eqNullSafe(F.col("_other")), "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0).cast("long"))).drop("_other")
    return out.select(F.col("_key").alias(key), "n_rows", *(["n_distinct"] if distinct else []), *(["latest"] if latest else []))


def heavy_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys that hold at least one in ``parts`` of all rows: null and empty keys count in the total and are no result.

    Columns: ``key``, ``n_rows``. Empty input gives no rows. The input is read once: the total is that of the written states."""
    states, chunks, merge = _states(df, key)
    total = states.agg(F.sum("n_rows")).first()[0] or 0
    counts = _merged(states, chunks, merge).where((F.col("_key") != "") & (F.col("n_rows") * parts >= total))
    return counts.select(F.col("_key").alias(key), "n_rows")


def p2_faq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, sessions and latest row of every FAQ name."""
    rows = table(spark, sf_dir, "robot_log").where("faq_name <> ''")
    out = per_key(rows, "faq_name", distinct="session_id", latest=["visit_time", "log_id"], keep=["question"])
    return out.select("faq_name", "n_rows", F.col("n_distinct").alias("n_sessions"), F.col("latest.visit_time").alias("last_time"), F.col("latest.log_id").alias("last_log_id"), F.col("latest.question").alias("last_question"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_keys(table(spark, sf_dir, "robot_log"), "faq_name", 20).select("faq_name")


SQL = {
    "p2_faq": """select faq_name, count(*) as n_rows, count(distinct session_id) as n_sessions, max(visit_time) as last_time,
      arg_max(log_id, row(coalesce(visit_time, ''), log_id)) as last_log_id, arg_max(coalesce(question, chr(0)), row(coalesce(visit_time, ''), log_id)) as last_question
      from robot_log where faq_name <> '' group by faq_name""",
    "p2_found": "select faq_name from (select faq_name, count(*) as n from robot_log group by 1) where faq_name <> '' and n * 20 >= (select count(*) from robot_log)",
}
QUERIES = {"p2_faq": p2_faq, "p2_found": p2_found}

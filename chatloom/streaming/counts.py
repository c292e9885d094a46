"""Extension: unanswered rows counted by event time over a stream of log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def log_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A stream of log rows from the Parquet files of a folder as they arrive, or from one file."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def windowed_types(rows: DataFrame, window: str = "1 hour", late: str = "2 days") -> DataFrame:
    """Rows of each answer type in tumbling windows of visit_time; rows later than the watermark are dropped."""
    timed = rows.withColumn("at", F.try_to_timestamp("visit_time", F.lit("yyyy-MM-dd HH:mm:ss"))).where("at is not null")
    kind = F.col("answer_type").try_cast("int")
    out = timed.withWatermark("at", late).groupBy(F.window("at", window)).agg(F.count("*").alias("n"), F.count_if(kind == 0).alias("cnt0"), F.count_if(kind == 11).alias("cnt11"))
    return out.select(F.col("window.start").alias("start"), "n", "cnt0", "cnt11")

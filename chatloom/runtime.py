"""Session helpers: shared scratch tables, size-checked broadcasts, streaming over sorted batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when its measured size stays below this many bytes.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_in_one_process(spark: SparkSession) -> bool:
    """Whether the executors live in the driver's process."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir as the cluster set it.

    Where it is unset a temporary folder is made if all executors live in this process (tests); any other master needs the setting."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not all_in_one_process(spark):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {sc.master} share")
        base = f"file://{tempfile.mkdtemp(prefix='chatloom-')}"
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


#: The folder of each application's scratch tables.
_ROOTS: dict[tuple[str, str], str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """One folder for all scratch tables of the session, removed when the driver's JVM ends."""
    key = (spark.sparkContext.applicationId, shared_folder(spark))
    if key not in _ROOTS:
        root = f"{key[1]}/chatloom-{uuid.uuid4().hex}"
        fs, path = _file(spark, root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _ROOTS[key] = root
    return _ROOTS[key]


def _file(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{_scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


#: How often scratch tables were removed: results kept from before are no longer readable.
_RELEASED = [0]


def release(spark: SparkSession) -> int:
    """Remove the session's scratch tables, once the results made from them are written; how many there were."""
    fs, path = _file(spark, _scratch_root(spark))
    _RELEASED[0] += 1
    held = fs.listStatus(path) if fs.exists(path) else []
    return sum(bool(fs.delete(x.getPath(), True)) for x in held)


def materialize(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back: the lineage is cut and survives lost executors."""
    path = scratch_path(df.sparkSession, tag)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str:
    """file:/x and file:///x as a plain path; other schemes stay as they are."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only for a side whose counted rows prove it small; otherwise leave it to a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def batches(it: Iterator[pa.RecordBatch], rows: int, max_bytes: int = 64 << 20) -> Iterator[pa.Table]:
    """Re-chunk Arrow batches to tables of about ``rows`` rows, or fewer where they would exceed ``max_bytes``."""
    held: list[pa.RecordBatch] = []
    n = size = 0
    for b in it:
        step = max(1, b.num_rows * max_bytes // max(b.nbytes, 1))
        for k in range(0, b.num_rows, step):
            held.append(b.slice(k, step))
            n += held[-1].num_rows
            size += held[-1].nbytes
            if n >= rows or size >= max_bytes:
                yield pa.Table.from_batches(held)
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)

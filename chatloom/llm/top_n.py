"""Problem 5: top N items within every group.

Statistics-guided skipping: the scored rows are written clustered by group, ordered by falling score within it, in small Parquet row
groups. Workers read each file's row groups in descending maximum score and skip those whose maximum is strictly below the current N-th
score of every group they contain, which the row group's own least and greatest group tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.runtime import scratch_path, table

#: Bytes and rows of a row group of the clustered files: what is skipped at once.
ROW_GROUP_BYTES, ROW_GROUP_ROWS = 1 << 20, 1 << 12
#: Rows of a clustered file: what a task reads.
FILE_ROWS = 1 << 20


def _best(x: pd.DataFrame, n: int) -> pd.DataFrame:
    """The n best items of each group: highest score, then smaller item; an item counts once with its highest score."""
    x = x.sort_values(["g", "s", "i"], ascending=[True, False, True], kind="stable").drop_duplicates(["g", "i"])
    return x.groupby("g", sort=False).head(n)


def _bounds(f) -> pd.DataFrame:
    """Of each row group: the maximum score (infinite if it isn't known) and the least and greatest group (None)."""
    names = f.schema_arrow.names
    told = []
    for k in range(f.num_row_groups):
        g, s = (f.metadata.row_group(k).column(names.index(c)).statistics for c in ("g", "s"))
        known = g is not None and g.has_min_max
        told.append((s.max if s is not None and s.has_min_max else np.inf, g.min if known else None, g.max if known else None))
    return pd.DataFrame(told, columns=["top", "low", "high"])


def _read_file(f, n: int) -> Iterator[tuple[pd.DataFrame | None, bool]]:
    """The best rows of each row group that is read, and whether it was skipped. Groups that end within a row group leave at once; of those
    that go on, n rows for each row group are held until the file's end."""
    bounds = _bounds(f)
    nth: dict[str, float] = {}
    # A group is in two row groups only as the greatest of one and the least of the next: all others are finished where they are read.
    lows, highs = bounds["low"].to_numpy(object), bounds["high"].to_numpy(object)
    open_ = {h for h, g in zip(highs[:-1], lows[1:]) if h is not None and h == g}
    sure = all(x is not None for x in lows) and all(h <= g for h, g in zip(highs[:-1], lows[1:]))
    held = []
    for k in np.argsort(-bounds["top"].to_numpy(float), kind="stable"):
        top, low, high = bounds.iloc[k]
        if sure and low == high and top < nth.get(low, -np.inf):
            yield None, True
            continue
        best = _best(f.read_row_group(k, columns=["g", "i", "s"]).to_pandas(), n)
        goes_on = best["g"].isin(open_) if sure else pd.Series(True, best.index)
        some = best[goes_on]
        size = some.groupby("g")["s"].agg(["size", "min"])
        for g, least in size.loc[size["size"] >= n, "min"].items():
            nth[g] = max(least, nth.get(g, -np.inf))
        held.append(some)
        yield best[~goes_on], False
    if held:
        yield _best(pd.concat(held), n), False


def read_best(n: int, count_skips: bool = False):
    """Read clustered files by their statistics. Rows: g, i, s; with ``count_skips`` the row groups read and skipped instead."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for paths in it:
            for uri in paths["path"]:
                system, path = fs.FileSystem.from_uri(uri)
                with pq.ParquetFile(system.open_input_file(path)) as f:
                    if count_skips:
                        skipped = sum(skip for _, skip in _read_file(f, n))
                        yield pd.DataFrame({"n_read": [f.num_row_groups - skipped], "n_skipped": [skipped]})
                    else:
                        for best, _ in _read_file(f, n):
                            if best is not None and len(best):
                                yield best

    return run


def cluster(df: DataFrame, group: str, item: str, score: str) -> DataFrame:
    """Write the scored rows clustered by group and return the files' paths. The input is read once: adaptive execution cuts the partition of
    a hot group into several files and joins small ones, by the bytes it sees, and no file has more than ``FILE_ROWS`` rows."""
    spark = df.sparkSession
    rows = df.select(F.col(group).cast("string").alias("g"), F.col(item).cast("string").alias("i"), F.col(score).cast("double").alias("s"))
    rows = rows.where("g is not null and i is not null and s is not null and not isnan(s)").withColumn("s", F.col("s") + F.lit(0.0))
    path = scratch_path(spark, "p5")
    (
        rows.hint("rebalance", "g").sortWithinPartitions("g", F.desc("s"), "i")
        .write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.block.row.count.limit", ROW_GROUP_ROWS).option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    )
    paths = spark.read.schema("g string, i string, s double").parquet(path).inputFiles()
    made = spark.createDataFrame([(p,) for p in paths], "path string")
    return made.repartition(max(1, len(paths)), "path")


def top_n(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """The n best items of every group: columns ``group``, ``item``, ``score``, rank.

    Order: falling score, on equal scores the smaller item by character code, so that every run gives the same rows. An item that comes
    again in its group counts once with its highest score. Rows with null group, item or score, or a NaN score, are left out; empty strings
    are ordinary values here. A group with fewer items gives all of them; an empty table none. Group and item come out as strings, the
    score as double; other columns of ``df`` are ignored whatever their names."""
    best = cluster(df, group, item, score).mapInPandas(read_best(n), "g string, i string, s double")
    # At most n rows of a group are left of each file. An item can be in several files of a hot group: its highest score stays.
    here = best.repartition("g").withColumn("again", F.row_number().over(W.partitionBy("g", "i").orderBy(F.desc("s")))).where("again = 1")
    rank = F.row_number().over(W.partitionBy("g").orderBy(F.desc("s"), "i"))
    return here.withColumn("rank", rank).where(F.col("rank") <= n).select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), "rank")


def p5_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five recent questions with the highest similarity for every question of yesterday, with their scores and ranks."""
    rows = table(spark, sf_dir, "sim_cross").where("yestques <> '' and recenques <> ''")
    return top_n(rows, "yestques", "recenques", "sim", 5)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_top(spark, sf_dir).select("yestques", "recenques")


_TOP = """
  d as (select yestques, recenques, max(sim) as sim from sim_cross where yestques <> '' and recenques <> '' and sim is not null and not isnan(sim) group by 1, 2),
  r as (select *, row_number() over (partition by yestques order by sim desc, recenques) as rank from d)
"""
SQL = {
    "p5_top": f"with {_TOP} select yestques, recenques, sim, rank from r where rank <= 5",
    "p5_found": f"with {_TOP} select yestques, recenques from r where rank <= 5",
}
QUERIES = {"p5_top": p5_top, "p5_found": p5_found}

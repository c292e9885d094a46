"""Ranking: top N per key, ranks with group sizes, data-dependent cuts, global numbers, recommendation of FAQs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.runtime import materialize

# Neighbours, classes and the training cut.
NEIGHBOURS, CLASSES = 11, 5
LEAST_SAMPLES, SHARE = 20, 100
#: Parts of the equally frequent values of a key that are cut apart.
SALTS = 64


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; the order must be total for the same rows on every run. Spark cuts before the exchange (WindowGroupLimit)."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def ranked_with_size(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """top_per_key with the number of rows left in each key."""
    return top_per_key(df, keys, order, n).withColumn("size", F.count("*").over(W.partitionBy(*keys)))


def samples_per_key(df: DataFrame, key: str, value: str, least: int = LEAST_SAMPLES, share: int = SHARE) -> DataFrame:
    """The most frequent values of each key: ``least`` plus one for every ``share`` rows of the key. Ties: smaller value.

    A key's values are first cut by their counts (how many values have each count tells where the cut lies), so that no task ranks all
    values of a hot key: only values of the same count are ordered, and of those at the cut each salt keeps what the cut may need."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"))
    levels = n.groupBy(key, "n").agg(F.count("*").alias("_m"))
    here = W.partitionBy(key)
    levels = levels.withColumn("total", F.sum(F.col("n") * F.col("_m")).over(here)).withColumn("_before", F.coalesce(F.sum("_m").over(here.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    cut = levels.withColumn("_need", F.lit(least) + F.expr(f"total div {share}") - F.col("_before")).where("_need > 0").select(F.col(key).alias("_key"), F.col("n").alias("_n"), "total", "_before", "_need")
    kept = n.join(cut, F.col(key).eqNullSafe(F.col("_key")) & (F.col("n") == F.col("_n")))
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(SALTS))).withColumn("_place", F.row_number().over(W.partitionBy(key, "n", "_salt").orderBy(value))).where("_place <= _need")
    placed = salted.withColumn("_place", F.row_number().over(W.partitionBy(key, "n").orderBy(value))).where("_place <= _need")
    return placed.select(key, value, "n", "total", (F.col("_before") + F.col("_place")).cast("int").alias("rank"))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Global row numbers from 0 in the order of the columns, without one global task: rows are range-partitioned, numbered within each
    partition, and moved on by the counts of the partitions before (one number per partition comes to the driver)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "numbers")
    sizes = {r["_pid"]: r["n"] for r in local.groupBy("_pid").agg(F.count("*").alias("n")).collect()}
    start, offsets = 0, []
    for pid in sorted(sizes):
        offsets += [F.lit(pid), F.lit(start).cast("long")]
        start += sizes[pid]
    offset = F.create_map(*offsets)[F.col("_pid")] if offsets else F.lit(0).cast("long")
    return local.withColumn(name, F.col("_row") + offset).drop("_pid", "_row")


def knn_recommend(samples: DataFrame, k: int = NEIGHBOURS, classes: int = CLASSES) -> DataFrame:
    """FAQs voted for by the k most similar questions. samples: question, similar, similarity, faq. Ties: smaller similar, smaller faq."""
    near = top_per_key(samples, ["question"], [F.desc("similarity"), F.col("similar"), F.col("faq")], k)
    votes = near.groupBy("question", "faq").agg(F.count("*").cast("double").alias("score"))
    return top_per_key(votes, ["question"], [F.desc("score"), F.col("faq")], classes).drop("rank")


def parse_ranked_line(line: Column) -> tuple[Column, Column]:
    """A classifier's line ``question TAB label TAB p,faq|p,faq`` as question and array of (faq, score)."""
    parts = F.split(line, "\t")
    one = lambda x: F.struct(F.substring_index(x, ",", 1).try_cast("double").alias("score"), F.regexp_extract(x, r"^[^,]*,(.*)$", 1).alias("faq"))
    return F.get(parts, F.lit(0)), F.transform(F.split(F.get(parts, F.lit(2)), r"\|"), one)


def parse_labels(line: Column) -> Column:
    """A classifier's ``__label__faq p __label__faq p``: array of (faq, score); ``_sp_`` in a label stands for a blank."""
    pieces = F.filter(F.split(line, "__label__"), lambda x: F.trim(x) != "")
    return F.transform(pieces, lambda x: F.struct(F.replace(F.regexp_extract(x, r"^(\S*)", 1), F.lit("_sp_"), F.lit(" ")).alias("faq"), F.regexp_extract(x, r"^\S*\s+(\S+)", 1).try_cast("double").alias("score")))


def merge_recommendations(parts: list[DataFrame], ids: DataFrame, classes: int = CLASSES, drop_known: bool = True) -> DataFrame:
    """Scores of several recommenders summed per question and FAQ, the best of each question with rank and number, and the FAQ's id.

    With ``drop_known`` a question that is itself one of its recommended FAQs is left out."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    scores = rows.groupBy("question", "faq").agg(F.sum("score").alias("score"))
    best = ranked_with_size(scores, ["question"], [F.desc("score"), F.col("faq")], classes)
    if drop_known:
        known = best.where(F.trim("question") == F.trim("faq")).select("question").distinct()
        best = best.join(known, "question", "left_anti")
    return best.join(ids.select(F.col("faq_name").alias("faq"), F.col("latest_id").alias("faq_id")), "faq", "left").withColumn("faq_id", F.coalesce("faq_id", F.lit("")))


def unite_labels(lines: DataFrame, line: str, ids: DataFrame, classes: int = CLASSES, with_scores: bool = True) -> DataFrame:
    """Classifiers' lines ``cluster TAB … TAB __label__faq p __label__faq p`` merged: the best FAQs of each cluster with rank, number and id.

    Scores of a cluster's equal FAQs are summed; without ``with_scores`` each label counts 1."""
    parts = F.split(F.col(line), "\t")
    each = lines.select(F.get(parts, F.lit(0)).alias("question"), F.explode(parse_labels(F.element_at(parts, -1))).alias("p"))
    return merge_recommendations([each.select("question", "p.faq", (F.col("p.score") if with_scores else F.lit(1.0)).alias("score"))], ids, classes, drop_known=False).withColumnRenamed("question", "cluster")


def training_lines(samples: DataFrame, label: str, segment: str) -> DataFrame:
    """Lines ``__label__F TAB segment`` for a text classifier; blanks in a label become ``_sp_``."""
    return samples.select(F.concat(F.lit("__label__"), F.replace(F.col(label), F.lit(" "), F.lit("_sp_")), F.lit("\t"), F.col(segment)).alias("line"))


def best_of_cluster(members: DataFrame, weights: DataFrame, key: str = "text") -> DataFrame:
    """The heaviest member of each cluster: group, cluster, text, weight. Members without a weight count as 0; ties: smaller text."""
    joined = members.join(weights, key, "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    return top_per_key(joined, ["group", "cluster"], [F.desc("weight"), F.col(key)], 1).select("group", "cluster", key, "weight")


def require_rows(df: DataFrame, least: int = 2) -> DataFrame:
    """The table itself, if it has at least ``least`` rows; an error names the shortage otherwise. Reads no more than ``least`` rows."""
    n = len(df.select(F.lit(1)).take(least))
    if n < least:
        raise ValueError(f"{n} rows, at least {least} are needed")
    return df

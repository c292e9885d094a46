"""Problem 1: items that appear together, with how far beyond chance.

External sort of packed 64-bit pair codes. Every basket's item numbers are packed pairwise into ``a << 32 | b``; each task
sorts its codes in bounded runs and run-length counts them, the runs are exchanged by code and merged by Spark's external
sorter (spilled sorted runs, multiway merge), and one pass over the merged stream run-length counts the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import broadcast_if_small, materialize, table

#: Codes sorted at once in a task (8 bytes each); more give several runs.
RUN_CODES = 1 << 20
#: Items of one basket held in one array, on average; larger baskets are split into chunks, and pairs of chunks are separate rows.
CHUNK_ITEMS = 512


def _item_numbers(items: DataFrame) -> tuple[DataFrame, int]:
    """Number items densely in string order without one global task: number within range partitions, add counted offsets."""
    ranged = items.repartitionByRange("item").sortWithinPartitions("item")
    local = materialize(ranged.withColumn("pid", F.spark_partition_id()).withColumn("rn", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "p1-items")
    counts = {r.pid: r.n for r in local.groupBy("pid").agg(F.count("*").alias("n")).collect()}  # one row per partition
    offsets, total = {}, 0
    for pid in sorted(counts):
        offsets[pid], total = total, total + counts[pid]
    if total >= 1 << 31:
        raise ValueError("more than 2^31 distinct items don't fit the packed code")
    if not offsets:
        return local.select("item", "n_item", F.lit(0).cast("long").alias("num")), 0
    offset = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
    return local.select("item", "n_item", (F.col("rn") + offset[F.col("pid")]).alias("num")), total


def _runs(codes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    c, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(c, kind="stable")
    c, n = c[order], n[order]
    start = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    return pa.record_batch({"code": c[start], "n": np.add.reduceat(n, start)})


def pack_pairs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with sorted arrays ``a`` and (for two chunks of one basket) ``b`` to sorted runs of (code, count)."""
    held: list[np.ndarray] = []
    n = 0

    def flush() -> pa.RecordBatch:
        return _runs(held, [np.ones(len(x), np.int64) for x in held])

    for batch in it:
        if not batch.num_rows:
            continue
        a, b = batch.column("a"), batch.column("b")
        alone = np.asarray(b.is_null().to_numpy(zero_copy_only=False))
        flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(a.value_lengths().to_numpy(zero_copy_only=False))
        sizes = np.diff(np.concatenate(([0], ends)))
        starts = ends - sizes
        for size in np.unique(sizes[alone]):
            if size < 2:
                continue
            first = starts[alone & (sizes == size)]
            i, j = np.triu_indices(size, 1)
            step = max(1, RUN_CODES // len(i))
            for k in range(0, len(first), step):
                block = flat[first[k : k + step, None] + np.arange(size)]
                held.append(((block[:, i] << 32) | block[:, j]).ravel())
                n += held[-1].size
                if n >= RUN_CODES:
                    yield flush()
                    held, n = [], 0
        for k in np.flatnonzero(~alone):
            x, y = flat[starts[k] : ends[k]], np.asarray(b[int(k)].values, np.int64)
            left, right = np.minimum(x[:, None], y), np.maximum(x[:, None], y)
            held.append(((left << 32) | right).ravel())
            n += held[-1].size
            if n >= RUN_CODES:
                yield flush()
                held, n = [], 0
    if held:
        yield flush()


def merge_runs(min_count: int):
    """Run-length count over the merged, code-ordered stream; a run may cross batches."""

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_code, last_n = None, 0
        for batch in it:
            if not batch.num_rows:
                continue
            c, n = batch.column("code").to_numpy(), batch.column("n").to_numpy()
            start = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            codes, sums = c[start], np.add.reduceat(n, start)
            if last_code is not None:
                if codes[0] == last_code:
                    sums[0] += last_n
                else:
                    codes, sums = np.concatenate(([last_code], codes)), np.concatenate(([last_n], sums))
            last_code, last_n = codes[-1], int(sums[-1])
            keep = sums[:-1] >= min_count
            if keep.any():
                yield pa.record_batch({"code": codes[:-1][keep], "n_ab": sums[:-1][keep]})
        if last_code is not None and last_n >= min_count:
            yield pa.record_batch({"code": np.array([last_code], np.int64), "n_ab": np.array([last_n], np.int64)})

    return merge


def item_pairs(df: DataFrame, basket: list[str], item: Column | str, min_count: int = 1) -> DataFrame:
    """Every pair of different items that share a basket.

    Columns: item_a < item_b, n_ab baskets with both, n_a, n_b, n_baskets, lift = n_ab * n / (n_a * n_b), odds_ratio with 0.5 added to
    each cell (Haldane-Anscombe), log_odds_z = log odds over its standard error. A null in a basket column is a value of its own; rows
    with a null item are left out; an item counts once per basket however often it is repeated; baskets of one item count in n_baskets.
    Other columns of ``df`` are ignored whatever their names. An empty input gives no rows. ``min_count`` (a floor on n_ab) prunes
    items in fewer baskets first, which loses no pair."""
    keys = [f"k{i}" for i in range(len(basket))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(basket, keys)], (F.col(item) if isinstance(item, str) else item).alias("item")).where("item is not null")
    # The distinct step needs no skewed task: its key holds the item, and repeats are combined before the exchange.
    held = materialize(rows.distinct(), "p1-rows")
    baskets = materialize(held.groupBy(*keys).agg(F.count("*").alias("n_items")), "p1-sizes")
    n = baskets.count()
    counts = held.groupBy("item").agg(F.count("*").alias("n_item")).where(F.col("n_item") >= min_count)
    numbers, total = _item_numbers(counts)
    numbered = held.join(broadcast_if_small(numbers, total, 64), "item").select(*keys, F.col("num").cast("int").alias("num"))
    # A large basket is cut in chunks by its items' hashes, so that no task ever holds it whole.
    large = baskets.where(F.col("n_items") > CHUNK_ITEMS).select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("n_items") / CHUNK_ITEMS).alias("chunks"))
    any_large = bool(large.head(1))
    if any_large:
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        numbered = numbered.join(large, same, "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("num"), F.col("chunks")), F.lit(-1)))
    else:
        numbered = numbered.withColumn("chunk", F.lit(-1).cast("long"))
    chunked = materialize(numbered.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list("num")).alias("a")), "p1-baskets")
    arrays = chunked.where(F.size("a") > 1).select("a", F.lit(None).cast("array<int>").alias("b"))
    if any_large:
        one, two = chunked.where("chunk >= 0").alias("l"), chunked.where("chunk >= 0").alias("r")
        crossed = one.join(two, [*[F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], F.col("l.chunk") < F.col("r.chunk")]).select(F.col("l.a").alias("a"), F.col("r.a").alias("b"))
        arrays = arrays.unionByName(crossed)
    runs = arrays.mapInArrow(pack_pairs, "code long, n long")
    merged = runs.repartition("code").sortWithinPartitions("code").mapInArrow(merge_runs(min_count), "code long, n_ab long")
    coded = merged.select(F.shiftright("code", 32).alias("num_a"), F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).alias("num_b"), "n_ab")
    side = lambda s: broadcast_if_small(numbers.select(F.col("num").alias(f"num_{s}"), F.col("item").alias(f"item_{s}"), F.col("n_item").alias(f"n_{s}")), total, 64)
    out = coded.join(side("a"), "num_a").join(side("b"), "num_b").withColumn("n_baskets", F.lit(n).cast("long"))
    both, only_a, only_b = F.col("n_ab") + 0.5, F.col("n_a") - F.col("n_ab") + 0.5, F.col("n_b") - F.col("n_ab") + 0.5
    none = F.col("n_baskets") - F.col("n_a") - F.col("n_b") + F.col("n_ab") + 0.5
    odds = both * none / (only_a * only_b)
    return out.select(
        "item_a", "item_b", "n_ab", "n_a", "n_b", "n_baskets",
        (F.col("n_ab").cast("double") * F.col("n_baskets") / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
        odds.alias("odds_ratio"), (F.log(odds) / F.sqrt(1 / both + 1 / only_a + 1 / only_b + 1 / none)).alias("log_odds_z"),
    )


def _retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "retail_action").select("pno", "vipno", F.trim("prodno").alias("prodno"))
    return rows.where("pno <> '' and prodno <> ''")


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All product pairs on the same receipt of the same member."""
    pairs = item_pairs(_retail(spark, sf_dir), ["pno", "vipno"], "prodno")
    return pairs.select(F.col("item_a").alias("prodno_a"), F.col("item_b").alias("prodno_b"), "n_ab", "n_a", "n_b", "n_baskets", F.round("lift", 6).alias("lift"), F.round("odds_ratio", 6).alias("odds_ratio"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = item_pairs(_retail(spark, sf_dir), ["pno", "vipno"], "prodno", min_count=5)
    big = lambda c: F.col(c).cast("decimal(18,0)")
    return pairs.where(big("n_ab") * big("n_baskets") >= 3 * big("n_a") * big("n_b")).select(F.col("item_a").alias("prodno_a"), F.col("item_b").alias("prodno_b"))


_BASKETS = """
  b as (select distinct pno, vipno, trim(prodno) as p from retail_action where pno <> '' and trim(prodno) <> ''),
  n as (select count(*) as n from (select distinct pno, vipno from b)),
  c as (select p, count(*) as k from b group by p),
  x as (select l.p as a, r.p as b, count(*) as k from b l join b r on l.pno = r.pno and l.vipno is not distinct from r.vipno and l.p < r.p group by 1, 2),
  y as (select a as prodno_a, x.b as prodno_b, x.k as n_ab, c1.k as n_a, c2.k as n_b, n.n as n_baskets from x join c c1 on c1.p = a join c c2 on c2.p = x.b, n)
"""
SQL = {
    "p1_pairs": f"with {_BASKETS} select *, round(cast(n_ab as double) * n_baskets / (cast(n_a as double) * n_b), 6) as lift, "
    "round((n_ab + 0.5::double) * (n_baskets - n_a - n_b + n_ab + 0.5::double) / ((n_a - n_ab + 0.5::double) * (n_b - n_ab + 0.5::double)), 6) as odds_ratio from y",
    "p1_found": f"with {_BASKETS} select prodno_a, prodno_b from y where n_ab >= 5 and n_ab * n_baskets >= 3 * n_a * n_b",
}
QUERIES = {"p1_pairs": p1_pairs, "p1_found": p1_found}

"""Clustering of texts and the outputs of classifiers on top of pyspark.ml.

Sequential algorithms run with a fixed order: density clusters of a group beyond ``MAX_PAIRS`` rows of pairs, and canopies, are made in
parallel rounds with the outcome of the sequential pass."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.operators.cells import in_cells, runs
from chatloom.operators.ranking import numbered
from chatloom.runtime import batches, materialize, scratch_path

#: Rows of similar pairs of a group that go to one task; larger groups are clustered in rounds.
MAX_PAIRS = 1_280_000
GROUP_LENGTH = 1000
ITERATIONS = 20
#: Centres of a block, blocks that a task keeps, rows that are placed at once, and of these, rows whose products are held.
BLOCK, BLOCKS, POINTS, STEP = 256, 2, 1 << 16, 1 << 12
#: In place of a feature's number: the rows of a group, and the sum of their squared distances.
COUNT, COST = -1, -2
SIMILARITY = 0.66


def kmeans_groups(df: DataFrame, tokens: str, group_length: int = GROUP_LENGTH, seed: int = 1, features: int = 1 << 18) -> DataFrame:
    """Rows with the group of a K-means over TF-IDF vectors; one group for each ``group_length`` rows, at least one.

    Centres start from random rows and are moved ITERATIONS times at most, fewer where no row comes nearer any more. They are as many as the
    rows' thousandth, so they don't pass the driver: their sums are a table in the shared folder, sparse and in blocks of BLOCK groups, which
    the tasks read block by block. A centre left by all rows stays where it is."""
    k = max(1, df.count() // group_length)
    if k == 1:
        return df.withColumn("group", F.lit(0))
    rows = materialize(df.withColumn("_id", F.monotonically_increasing_id()), "kmeans-rows")
    spark = rows.sparkSession
    hashed = F.transform(F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: F.pmod(F.xxhash64(x), F.lit(features)).cast("int"))
    words = rows.select("_id", hashed.alias("f"))
    points = materialize(words.mapInArrow(_weighted(_idf(words, features)), "_id long, f array<int>, w array<float>"), "kmeans-points")
    # About 2 k rows by a hash of their numbers, of which the k least, each vector once.
    place = F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1 << 32))
    some = points.withColumn("_place", place).where(F.col("_place") < int((1 << 32) * min(1.0, (2 * k + 64) / max(1, rows.count()))))
    drawn = numbered(some, ["_place", "_id"], "_rank").where(F.col("_rank") < k)
    drawn = numbered(drawn.groupBy("f", "w").agg(F.min("_rank").alias("_rank")), ["_rank"], "_group")
    k = drawn.count()
    group = F.col("_group").cast("int").alias("group")
    sums = drawn.select(group, F.explode(F.arrays_zip("f", "w")).alias("e")).select("group", F.col("e.f").alias("feature"), F.col("e.w").cast("double").alias("value"))
    path = _centres(sums.unionByName(drawn.select(group, F.lit(COUNT).alias("feature"), F.lit(1.0).alias("value"))))
    cost = math.inf
    for _ in range(ITERATIONS):
        sums = points.mapInArrow(_nearest(path, k, features, True), "group int, feature int, value double").groupBy("group", "feature").agg(F.sum("value").alias("value"))
        now = _centres(sums)
        held = spark.read.schema(_SUMS).parquet(now)
        told = held.where("feature < 0").agg(F.sum(F.when(F.col("feature") == COST, F.col("value"))).alias("cost"), F.count_if(F.col("feature") == COUNT).alias("n")).first()
        if not told["cost"] < cost * (1 - 1e-9):
            break
        if told["n"] < k:
            _centres(spark.read.schema(_SUMS).parquet(path).where(F.col("feature") != COST).drop("block").join(held.select("group").distinct(), "group", "left_anti"), now)
        path, cost = now, told["cost"]
    found = points.select("_id", "f", "w").mapInArrow(_nearest(path, k, features, False), "_id long, group int")
    return rows.join(found, "_id").drop("_id")


_SUMS = "group int, feature int, value double, block int"


def _centres(sums: DataFrame, path: str | None = None) -> str:
    """Sums of the groups' vectors written by blocks of groups; the folder."""
    path = path or scratch_path(sums.sparkSession, "kmeans-centres")
    sums.withColumn("block", F.floor(F.col("group") / BLOCK).cast("int")).write.mode("append").partitionBy("block").parquet(path)
    return path


def _idf(words: DataFrame, features: int):
    """The inverse document frequency of each feature, sent to all executors."""
    got = words.select(F.explode(F.array_distinct("f")).alias("feature")).groupBy("feature").agg(F.count("*").alias("n")).toPandas()
    n = np.zeros(features)
    n[got["feature"].to_numpy(int)] = got["n"].to_numpy(float)
    return words.sparkSession.sparkContext.broadcast(np.log((words.count() + 1) / (n + 1)))


def _weighted(idf):
    """TF-IDF vectors: the distinct features of each row and their weights."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            f = b.column("f")
            flat = f.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), f.value_lengths().to_numpy(zero_copy_only=False))
            keys, n = np.unique(row * len(idf.value) + flat, return_counts=True)
            row, flat = np.divmod(keys, len(idf.value))
            ends = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (flat.astype(np.int32), (n * idf.value[flat]).astype(np.float32))]
            yield pa.RecordBatch.from_arrays([b.column("_id"), *lists], names=["_id", "f", "w"])

    return run


def _block_of(path: str, block: int):
    """Group, feature and value of a block's centres, and the square of each centre's length."""
    from pyarrow import dataset, fs

    system, folder = fs.FileSystem.from_uri(f"{path}/block={block}")
    got = dataset.dataset(folder, filesystem=system, format="parquet").to_table(columns=["group", "feature", "value"])
    group, feature, value = (got.column(c).to_numpy() for c in ("group", "feature", "value"))
    group = group - block * BLOCK
    count, own = np.ones(BLOCK), feature >= 0
    count[group[feature == COUNT]] = value[feature == COUNT]
    group, feature, value = group[own], feature[own], value[own] / count[group[own]]
    return group, feature, value.astype(np.float32), np.bincount(group, value * value, BLOCK)


def _nearest(path: str, k: int, features: int, summed: bool):
    """The group of the nearest centre of each row, the first of equals; ``summed``: the sums of each group's vectors instead, with the number
    of its rows as feature COUNT and the sum of their squared distances as COST."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for b in batches(it, POINTS):
            if not b.num_rows:
                continue
            b = b.combine_chunks()
            f, w = (b.column(c).combine_chunks() for c in ("f", "w"))
            flat, weight = f.flatten().to_numpy(), w.flatten().to_numpy()
            size = f.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            # The rows with most features first: those with a j-th one are the first rows then.
            order = np.argsort(-size, kind="stable")
            start = (np.cumsum(size) - size)[order]
            lengths = size[order]
            known, local = np.unique(flat, return_inverse=True)
            best, near = np.full(b.num_rows, np.inf), np.zeros(b.num_rows, np.int32)
            for block in range(-(-k // BLOCK)):
                if block not in held:
                    held = {**held, block: _block_of(path, block)} if len(held) < BLOCKS else {block: _block_of(path, block)}
                group, feature, value, square = held[block]
                width = min(BLOCK, k - block * BLOCK)
                at = np.searchsorted(known, feature)
                met = at < len(known)
                met[met] = known[at[met]] == feature[met]
                table = np.zeros((len(known), width), np.float32)
                table[at[met], group[met]] = value[met]
                for low in range(0, b.num_rows, STEP):
                    mine = slice(low, low + STEP)
                    begin, long = start[mine], lengths[mine]
                    dot = np.zeros((len(begin), width), np.float32)
                    for j in range(int(long[0])):
                        m = int(np.searchsorted(-long, -j, side="left"))
                        e = begin[:m] + j
                        dot[:m] += table[local[e]] * weight[e, None]
                    far = square[:width] - 2.0 * dot
                    pick = far.argmin(1)
                    far = far[np.arange(len(pick)), pick]
                    rows = order[mine]
                    nearer = far < best[rows]
                    best[rows[nearer]], near[rows[nearer]] = far[nearer], pick[nearer] + block * BLOCK
            if not summed:
                yield pa.RecordBatch.from_arrays([b.column("_id").combine_chunks(), pa.array(near)], names=["_id", "group"])
                continue
            row = np.repeat(np.arange(b.num_rows), size)
            keys, inverse = np.unique(near[row] * np.int64(features) + flat, return_inverse=True)
            group, feature = np.divmod(keys, features)
            groups, n = np.unique(near, return_counts=True)
            cost = float(best.sum() + np.square(weight.astype(float)).sum())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([group, groups, groups[:1]]).astype(np.int32)),
                pa.array(np.concatenate([feature, np.full(len(groups), COUNT), [COST]]).astype(np.int32)),
                pa.array(np.concatenate([np.bincount(inverse, weight, len(keys)), n, [cost]])),
            ], names=["group", "feature", "value"])

    return run


def _texts(df: DataFrame, group: str, text: str) -> DataFrame:
    """The distinct texts of each group: group, x, with the group's number g and the text's place r in it by name."""
    rows = df.select(F.col(group).alias("group"), F.col(text).alias("x")).where("x is not null").distinct().withColumn("_id", F.monotonically_increasing_id())
    order = W.partitionBy("group").orderBy("x")
    return materialize(rows.select("group", "x", F.first("_id").over(order).alias("g"), (F.row_number().over(order) - 1).cast("long").alias("r")), "group-texts")


def similar_in_group(df: DataFrame, group: str, text: str, t: float = SIMILARITY) -> DataFrame:
    """Ordered pairs of different texts of a group whose edit similarity reaches t: group, a, b, sim."""
    rows = _texts(df, group, text)
    pairs = materialize(in_cells(rows.select("g", F.col("r").alias("id"), "x"), t), "group-pairs")
    one, two = rows.select("g", F.col("r").alias("i"), "group", F.col("x").alias("a")), rows.select("g", F.col("r").alias("j"), F.col("x").alias("b"))
    scored = materialize(pairs.join(one, ["g", "i"]).join(two, ["g", "j"]).select("group", "a", "b", "sim"), "group-pairs")
    return scored.unionByName(scored.select("group", F.col("b").alias("a"), F.col("a").alias("b"), "sim"))


def _greedy(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a group's pairs in both directions (b null for each text itself): texts, their clusters and flags. Texts are numbered by name."""
    own = np.isnan(b)
    n = int(own.sum())
    a, b, sim = a[~own].astype(np.int64), b[~own].astype(np.int64), sim[~own]
    order = np.lexsort((b, -sim, a))
    b, near = b[order], np.bincount(a, minlength=n)
    start = np.cumsum(near) - near
    of, flag, last = np.full(n, -1, np.int64), np.ones(n, np.int32), -1
    turn = np.lexsort((np.arange(n), -near))
    linked = int((near > 0).sum())
    for text in turn[:linked]:
        if of[text] >= 0:
            continue
        mine = b[start[text] : start[text] + near[text]]
        taken = of[mine] >= 0
        core = mine[taken & (flag[mine] == 1)][:1]
        free = np.append(mine[~taken], text)
        if len(core):
            of[free], flag[free] = of[core[0]], 0
        else:
            last += 1
            of[free] = last
    of[turn[linked:]] = last + 1 + np.arange(n - linked)  # texts without neighbours
    return np.arange(n), of, flag


def _greedy_runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in runs(it, ["group"], 1 << 12):
        g, a, b, sim = (part.column(c).to_numpy() for c in ("group", "a", "b", "sim"))
        b = b.astype(float)  # null as NaN
        edges = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
        made = [(low, *_greedy(a[low:high], b[low:high], sim[low:high])) for low, high in zip(edges[:-1], edges[1:])]
        columns = [np.concatenate([np.full(len(m[1]), g[m[0]]) for m in made]), *(np.concatenate([m[k] for m in made]) for k in (2, 1, 3))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["group", "cluster", "text", "flag"])


def _finish(p: np.ndarray, q: np.ndarray, r: np.ndarray, sim: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pass over a group's texts that rounds left free, from their links (cluster NaN) and the nearest core of each that has one: texts,
    their clusters and flags."""
    told = np.flatnonzero(~np.isnan(cluster))
    near = {int(p[k]): (-sim[k], r[k], int(cluster[k])) for k in told}
    own = np.flatnonzero(np.isnan(cluster))
    own = own[np.lexsort((r[own], -sim[own], p[own]))]
    texts, start = np.unique(p[own], return_index=True)
    q, r, sim, end = np.searchsorted(texts, q[own]), r[own], sim[own], np.append(start[1:], len(own))
    of, flag = np.full(len(texts), -1, np.int64), np.zeros(len(texts), np.int32)
    for k, text in enumerate(texts):
        if of[k] >= 0:
            continue
        mine, best = q[start[k] : end[k]], near.get(int(text))
        taken = of[mine] >= 0
        for core in start[k] + np.flatnonzero(taken & (flag[mine] == 1))[:1]:
            here = (-sim[core], r[core], of[q[core]])
            best = here if best is None else min(best, here)
        free = mine[~taken]
        of[free], flag[free] = (text, 1) if best is None else (best[2], 0)
    return texts, of, flag


def _finish_runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in runs(it, ["g"], 1 << 12):
        g, *columns = (part.column(c).to_numpy() for c in ("g", "p", "q", "r", "sim", "cluster"))
        edges = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
        for low, high in zip(edges[:-1], edges[1:]):
            texts, of, flag = _finish(*(c[low:high] for c in columns))
            made = [np.full(len(texts), g[low]), texts.astype(np.int32), of.astype(np.int32), flag]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["g", "q", "cluster", "flag"])


_TAKEN = "g long, q int, cluster int, flag int"


def _rounds(pairs: DataFrame, kind: str, most: int) -> DataFrame:
    """What ``_greedy`` gives for groups of any size, in rounds. pairs: group, a, b, sim, a null b for each text itself.

    Each round settles all free texts that come before every free text with which they share a free neighbour (themselves included). These
    take disjoint texts, and no text settled later could have come before them, so the outcome is that of one text after the other. The
    first free text of a group is always settled; a round costs joins over the links between texts still free. Once no group has more than
    ``most`` of these, each is finished by one task. What rounds settle is one table in the shared folder, so that the plan in the driver
    doesn't grow with them."""
    # Numbers in place of texts: g a group, p the place in the order of the pass, r the place by name.
    groups = materialize(pairs.select("group").distinct().withColumn("g", F.monotonically_increasing_id()), "cluster-groups")
    numbered = pairs.join(F.broadcast(groups.withColumnRenamed("group", "_group")), F.col("group").eqNullSafe(F.col("_group"))).select("g", "a", "b", "sim")
    order = W.partitionBy("g")
    texts = numbered.groupBy("g", "a").agg(F.count("*").alias("n"))
    texts = texts.select("g", F.col("a").alias("text"), F.row_number().over(order.orderBy(F.desc("n"), "a")).alias("p"), F.row_number().over(order.orderBy("a")).alias("r"))
    texts = materialize(texts, "cluster-texts")
    left, right = texts.select("g", F.col("text").alias("a"), "p"), texts.select("g", F.col("text").alias("b"), F.col("p").alias("q"), "r")
    # p's neighbour q with its place by name; a text is its own neighbour.
    links = materialize(numbered.withColumn("b", F.coalesce("b", "a")).join(left, ["g", "a"]).join(right, ["g", "b"]).select("g", "p", "q", "r", "sim"), "cluster-links")
    # near: the most similar core neighbour so far (then by name) with its cluster, which the place of its first text names.
    free = materialize(texts.select("g", "p", F.lit(None).cast("struct<far:double,r:int,cluster:int>").alias("near")), "cluster-free")
    spark, path, turn = pairs.sparkSession, scratch_path(pairs.sparkSession, "cluster-taken"), 0
    while links.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > most).head(1):
        first = links.groupBy("g", "q").agg(F.min("p").alias("first"))
        ready = links.join(first, ["g", "q"]).groupBy("g", "p").agg(F.min("first").alias("first")).where(F.col("first") == F.col("p")).select("g", "p")
        opened = free.join(ready, ["g", "p"]).select("g", "p", F.coalesce("near.cluster", "p").alias("cluster"), F.col("near").isNull().cast("int").alias("flag"))
        links.join(opened, ["g", "p"]).select("g", "q", "r", "cluster", "flag").write.parquet(f"{path}/round={turn}")
        now = spark.read.schema("g long, q int, r int, cluster int, flag int").parquet(f"{path}/round={turn}")
        turn += 1
        gone = now.select("g", F.col("q").alias("p"))
        still = links.join(gone, ["g", "p"], "left_anti")
        met = still.join(now.where("flag = 1").select("g", "q", "cluster"), ["g", "q"]).groupBy("g", "p").agg(F.min(F.struct((-F.col("sim")).alias("far"), "r", "cluster")).alias("met"))
        free = materialize(free.join(gone, ["g", "p"], "left_anti").join(met, ["g", "p"], "left").select("g", "p", F.least("near", "met").alias("near")), "cluster-free")
        links = materialize(still.join(now.select("g", "q"), ["g", "q"], "left_anti"), "cluster-links")
    near = free.where("near is not null").select("g", "p", F.col("p").alias("q"), "near.r", (-F.col("near.far")).alias("sim"), "near.cluster")
    left = links.withColumn("cluster", F.lit(None).cast("int")).unionByName(near)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left.repartition(parts, "g").sortWithinPartitions("g").mapInArrow(_finish_runs, _TAKEN).write.parquet(f"{path}/round={turn}")
    made = spark.read.schema(_TAKEN).parquet(path).drop("round")
    ids = made.select("g", "cluster").distinct().withColumn("id", F.row_number().over(order.orderBy("cluster")) - 1)
    named = made.join(ids, ["g", "cluster"]).join(texts.select("g", F.col("p").alias("q"), "text"), ["g", "q"]).join(F.broadcast(groups), "g")
    return named.select(F.col("group").cast(kind), F.col("id").cast("long").alias("cluster"), "text", "flag")


def density_clusters(df: DataFrame, group: str, text: str, t: float = SIMILARITY, most: int = MAX_PAIRS) -> DataFrame:
    """Greedy clusters by number of neighbours within each group: group, cluster, text, flag (1 core, 0 edge).

    A text with the most neighbours opens a cluster with all its unassigned neighbours; one that has a core neighbour joins that cluster
    with its neighbours as edge; edges draw in none. Null texts are left out, repeated ones count once. A group of more than ``most`` rows
    of pairs isn't given to one task but clustered in rounds until that many are left, with the same outcome."""
    # All in numbers: texts by their places by name in their groups, and each group's number as ``group``.
    rows = _texts(df, group, text)
    met = materialize(in_cells(rows.select("g", F.col("r").alias("id"), "x"), t), "group-pairs")
    met = met.select(F.col("g").alias("group"), F.col("i").alias("a"), F.col("j").alias("b"), "sim")
    alone = rows.select(F.col("g").alias("group"), F.col("r").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("double").alias("sim"))
    pairs = met.unionByName(met.select("group", F.col("b").alias("a"), F.col("a").alias("b"), "sim")).unionByName(alone)
    large = materialize(pairs.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > most).select("group"), "large-groups")
    some = bool(large.head(1))
    small = pairs.join(F.broadcast(large), "group", "left_anti") if some else pairs
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = small.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_greedy_runs, "group long, cluster long, text long, flag int")
    if some:
        made = made.unionByName(_rounds(pairs.join(F.broadcast(large), "group", "left_semi"), "long", most))
    named = made.select(F.col("group").alias("g"), "cluster", F.col("text").alias("r"), "flag").join(rows, ["g", "r"])
    return named.select("group", "cluster", F.col("x").alias("text"), "flag")


def cluster_weights(clusters: DataFrame, least: float = 0.0) -> DataFrame:
    """Size and weight (size - 1) / (largest - 1) of each cluster; null where the largest is 1. Weights below ``least`` are left out."""
    size = clusters.groupBy("group", "cluster").agg(F.count("*").alias("size"))
    most = F.broadcast(size.agg(F.max("size").alias("most")))  # one row
    out = size.join(most).withColumn("weight", F.when(F.col("most") > 1, (F.col("size") - 1) / (F.col("most") - 1))).drop("most")
    return out.where(F.col("weight").isNull() | (F.col("weight") >= least))


def cluster_id(*columns: str) -> Column:
    """A cluster's name: the same on every run, unlike a random one."""
    return F.sha2(F.concat_ws("|", *columns), 256)


def canopy(df: DataFrame, text: str, segment: str, order: str, t1: float, t2: float, limit: int | None = None) -> DataFrame:
    """Canopy clusters: text, cluster.

    In the order of ``order`` (then by text) a text becomes a centre if no centre before it is nearer than t2. Texts within t1 of a centre
    are its members; clusters are numbered by falling mean length of their members (then by centre); a text of several clusters gets the
    least number; texts of none share the next one. Null texts are left out, repeated ones count once (with their first order's segment).
    ``limit`` keeps the first rows by cluster and text, if given.

    Only pairs within the greater distance leave the cells of texts where they are worked out. The pass over the texts is made in
    rounds: a text all of whose earlier neighbours are known to be no centres is one, and its later neighbours are none."""
    rows = df.select(F.col(text).alias("x"), F.col(segment).alias("seg"), F.col(order).alias("o")).where("x is not null").groupBy("x").agg(F.min_by("seg", "o").alias("seg"), F.min("o").alias("o"))
    rows = rows.withColumn("seg", F.coalesce("seg", F.lit(""))).withColumn("id", F.monotonically_increasing_id())
    rows = materialize(rows.select("id", "x", "seg", "o"), "canopy-texts")
    words = rows.select(F.lit(0).cast("long").alias("g"), "id", F.replace("x", F.lit(" "), F.lit("")).alias("x"), F.split("seg", " ").alias("words"))
    far = max(t1, t2)
    side = lambda s: rows.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}{s}") for c in ("x", "o")])
    met = materialize(in_cells(words, 1 - far - 1e-6, words=True).select("i", "j", (1 - F.col("sim")).alias("d")).where(F.col("d") <= far), "canopy-pairs")
    both = met.join(side("i"), "i").join(side("j"), "j")
    before = F.struct("oi", "xi") < F.struct("oj", "xj")
    links = materialize(both.select(F.when(before, F.col("i")).otherwise(F.col("j")).alias("early"), F.when(before, F.col("j")).otherwise(F.col("i")).alias("late"), "d"), "canopy-links")
    free, left, made = rows.select("id"), links.where(F.col("d") < t2).select("early", "late"), None
    while free.head(1):
        now = materialize(free.join(left.select(F.col("late").alias("id")).distinct(), "id", "left_anti"), "canopy-centres")
        made = now if made is None else made.unionByName(now)
        gone = left.join(now.select(F.col("id").alias("early")), "early", "left_semi").select(F.col("late").alias("id")).distinct()
        free = materialize(free.join(now, "id", "left_anti").join(gone, "id", "left_anti"), "canopy-free")
        # Links from texts that are no centres fall away, as do all to texts that are settled.
        left = materialize(left.join(free.select(F.col("id").alias("early")), "early", "left_semi").join(free.select(F.col("id").alias("late")), "late", "left_semi"), "canopy-left")
    centres = rows.select("id").limit(0) if made is None else made
    near = links.where(F.col("d") <= t1)
    pairs = near.select(F.col("early").alias("centre"), F.col("late").alias("id")).unionByName(near.select(F.col("late").alias("centre"), F.col("early").alias("id")))
    members = pairs.join(centres.select(F.col("id").alias("centre")), "centre", "left_semi").unionByName(centres.select(F.col("id").alias("centre"), "id"))
    size = members.join(rows.select("id", F.length("x").alias("n")), "id").groupBy("centre").agg(F.avg("n").alias("mean"))
    ids = numbered(size.join(rows.select(F.col("id").alias("centre"), "x"), "centre").withColumn("_down", -F.col("mean")), ["_down", "x"], "cluster").select("centre", "cluster")
    best = members.join(ids, "centre").groupBy("id").agg(F.min("cluster").alias("cluster"))
    rest = F.broadcast(ids.agg((F.coalesce(F.max("cluster"), F.lit(-1)) + 1).alias("rest")))  # one row
    every = rows.join(best, "id", "left").join(rest).select(F.col("x").alias("text"), F.coalesce("cluster", "rest").alias("cluster"))
    return every if limit is None else every.orderBy("cluster", "text").limit(limit)


def rarest_terms(clusters: DataFrame, tokens: str) -> DataFrame:
    """Sub-groups of each cluster: every text is put with the term of it that is rarest within the cluster (ties: the greater term)."""
    words = clusters.select("group", "cluster", "text", F.explode(F.array_distinct(tokens)).alias("term")).where("term <> ''")
    n = words.withColumn("n", F.count("*").over(W.partitionBy("group", "cluster", "term")))
    return n.groupBy("group", "cluster", "text").agg(F.max_by("term", F.struct(-F.col("n"), F.col("term"))).alias("term"))

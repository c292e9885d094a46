"""Problem 10: reading level of each document.

A document-word graph: each document is linked with its words (Latin-script words, pairs of neighbouring Han characters), hashed into a fixed
number of word nodes. Rated documents are clamped, and difficulty is propagated by harmonic iterations: a word takes the mean of its
documents, a document the weighted mean of its words. Words whose rated documents agree weigh more. The levels' borders are then placed
by ratings that were kept out of the propagation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import broadcast_if_small, materialize, table

#: Word nodes of the graph, 2 to this power at most 16: what the driver holds and sends is bounded by it.
WORD_BITS = 16
#: Harmonic iterations at most, and the greatest change of a word at which they end before.
ITERATIONS, TOLERANCE = 3, 1e-3
#: One in so many rated documents is kept out of the propagation and places the borders.
HELD_OUT = 5
#: Steps into which scores are divided to place the borders.
STEPS = 2000
LOWEST, HIGHEST = 1, 5
#: Prior weight, in documents, of a word's mean and spread.
PRIOR = 3.0
BLOCK_CHARS = 1 << 21

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_nodes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word nodes of every text as one array, and how many each has."""
    low = [t.lower() for t in texts]
    c = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    han = ((c >= 0x4E00) & (c <= 0x9FFF)) | ((c >= 0x3400) & (c <= 0x4DBF))
    letter = ((c >= 97) & (c <= 122)) | ((c >= 0xDF) & (c <= 0x52F))
    with np.errstate(over="ignore"):
        at = np.flatnonzero(han[:-1] & han[1:]) if len(c) else np.empty(0, int)
        pairs = (c[at].astype(np.uint64) << np.uint64(32)) | c[at + 1]
        edge = np.diff(letter.astype(np.int8), prepend=0)
        start, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)  # the last character is a line end, no letter
        # A word's hash from prefix sums of c[k] * B^k, brought to the same power by the inverse of B.
        power = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(c), _ODD))))
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(c.astype(np.uint64) * power[:-1])))
        down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(c), _INVERSE))))
        words = (prefix[end] - prefix[start]) * down[start]
        h = np.concatenate((pairs, words)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        node = (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key = np.unique((np.concatenate((doc[at], doc[start])) << WORD_BITS) | node)
    return (key & ((1 << WORD_BITS) - 1)).astype(np.uint16), np.bincount(key >> WORD_BITS, minlength=len(texts))


def _links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document's links as the bytes of sorted 16-bit node numbers."""
    for b in it:
        texts, start, size = b.column("text").to_pylist(), 0, 0
        for k in range(len(texts) + 1):
            if k == len(texts) or size >= BLOCK_CHARS:
                if k > start:
                    nodes, n = word_nodes(texts[start:k])
                    offsets = np.concatenate(([0], np.cumsum(n * 2))).astype(np.int32)
                    links = pa.Array.from_buffers(pa.binary(), k - start, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(nodes.tobytes())])
                    yield pa.RecordBatch.from_arrays([b.column("key").slice(start, k - start), links], names=["key", "links"])
                start, size = k, 0
            if k < len(texts):
                size += len(texts[k])


def _edges(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers of all links of a batch and each document's number of links."""
    links = b.column("links")
    n = pc.binary_length(links).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    data = links.buffers()[2]
    offsets = np.frombuffer(links.buffers()[1], np.int32)[links.offset : links.offset + len(links) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.uint16).astype(np.int64) if len(links) and data is not None else np.empty(0, np.int64), n


def _scores(nodes: np.ndarray, n: np.ndarray, mean: np.ndarray, weight: np.ndarray, base: float) -> np.ndarray:
    """Documents' weighted means over their words; ``base`` without any."""
    ends = np.cumsum(n)
    w = np.concatenate(([0.0], np.cumsum(weight[nodes])))
    v = np.concatenate(([0.0], np.cumsum((weight * mean)[nodes])))
    den = w[ends] - w[ends - n]
    return np.where(n > 0, (v[ends] - v[ends - n]) / np.where(n > 0, den, 1), base)


def _sums(mean: np.ndarray | None, weight: np.ndarray | None, base: float):
    """Word nodes' sums over a task's documents: rated and clamped ones, or all if ``mean`` is given."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << WORD_BITS
        total = np.zeros((3, size))
        for b in it:
            if not b.num_rows:
                continue
            nodes, n = _edges(b)
            level = b.column("level").to_numpy(zero_copy_only=False).astype(float)
            f = level if mean is None else np.where(np.isnan(level), _scores(nodes, n, mean, weight, base), level)
            each = np.repeat(f, n)
            total[0] += np.bincount(nodes, minlength=size)
            total[1] += np.bincount(nodes, each, minlength=size)
            total[2] += np.bincount(nodes, each * each, minlength=size)
        used = np.flatnonzero(total[0])
        if len(used):
            yield pa.record_batch({"node": used.astype(np.int32), "n": total[0][used], "s": total[1][used], "q": total[2][used]})

    return run


def _score(mean: np.ndarray, weight: np.ndarray, base: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            nodes, n = _edges(b)
            score = pa.array(_scores(nodes, n, mean, weight, base))
            yield pa.RecordBatch.from_arrays([b.column(0), *(b.column(i) for i in range(2, b.num_columns)), score], names=[b.schema.names[0], *b.schema.names[2:], "score"])

    return run


def _word_sums(links: DataFrame, mean=None, weight=None, base: float = 0.0) -> np.ndarray:
    """Sums of every word node, added up on the executors; what comes to the driver is bounded by the number of nodes."""
    out = np.zeros((3, 1 << WORD_BITS))
    parts = links.select("links", "level").mapInArrow(_sums(mean, weight, base), "node int, n double, s double, q double")
    got = parts.groupBy("node").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).toPandas()
    out[:, got["node"].to_numpy(int)] = got[["n", "s", "q"]].to_numpy(float).T
    return out


def borders(counts: np.ndarray) -> np.ndarray:
    """Scores' steps where each higher level begins, with the fewest held-out ratings on the wrong side. counts: steps by rounded level."""
    out = []
    for level in range(LOWEST + 1, HIGHEST + 1):
        below, above = counts[:, : level - LOWEST].sum(1), counts[:, level - LOWEST :].sum(1)
        wrong = np.concatenate(([0], np.cumsum(above))) + below.sum() - np.concatenate(([0], np.cumsum(below)))
        best = np.flatnonzero(wrong == wrong.min())
        out.append(int(best[len(best) // 2]))
    return np.maximum.accumulate(out)


def reading_levels(
    docs: DataFrame, key: str, text: str, ratings: DataFrame, rating_key: str, level: str, rater: str, careful: str, iterations: int = ITERATIONS
) -> DataFrame:
    """``key``, ``score`` (continuous difficulty) and ``level`` (1 to 5) of every document with text.

    Ratings that are null or outside 1 to 5 are left out and repeated ones count once; a document's rating is the mean of its raters', where
    rater ``careful`` counts three times as much. Documents of null or blank text give no row; one without any word gets the mean rating;
    repeated ids each give a row; texts are worked whole. A document's own rating doesn't enter its level: raters disagree, and its words
    decide. Without any valid rating every document has a null score and level. Other columns are ignored, whatever their names."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").rlike(r"[^\s\x{a0}\x{3000}]"))
    valid = ratings.select(F.col(rating_key).alias("rated"), F.col(rater).alias("rater"), F.col(level).alias("level")).where(f"rated is not null and level between {LOWEST} and {HIGHEST}").distinct()
    share = F.when(F.col("rater") == careful, 3.0).otherwise(1.0)
    rated = valid.groupBy("rated").agg((F.sum(F.col("level") * share) / F.sum(share)).alias("mean"))
    n = rated.count()
    linked = rows.mapInArrow(_links, f"key {kind}, links binary")
    held = F.pmod(F.xxhash64(F.col("rated").cast("string")), F.lit(HELD_OUT)) == 0
    joined = linked.join(broadcast_if_small(rated, n, 32), F.col("key") == F.col("rated"), "left")
    graph = materialize(joined.select("key", "links", F.when(~held, F.col("mean")).alias("level"), F.when(held, F.col("mean")).alias("held")), "p10-graph")
    clamped = graph.where("level is not null")
    stats = _word_sums(clamped)
    count = stats[0]
    base, spread = clamped.agg(F.avg("level"), F.var_pop("level")).first()
    if base is None:
        return graph.select(F.col("key").alias(key), F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("level"))
    mean = (stats[1] + PRIOR * base) / (count + PRIOR)
    square = (stats[2] + PRIOR * (spread + base * base)) / (count + PRIOR)
    weight = 1 / np.maximum(square - mean * mean, 0.05) ** 2
    for _ in range(iterations):
        sums = _word_sums(graph, mean, weight, base)
        last, mean = mean, np.where(sums[0] > 0, sums[1] / np.maximum(sums[0], 1), mean)
        if np.abs(mean - last).max() < TOLERANCE:
            break
    low, high = float(mean.min()), float(mean.max())
    step = lambda c: F.least(F.greatest(F.floor((c - low) / max(high - low, 1e-9) * STEPS), F.lit(0)), F.lit(STEPS - 1)).cast("int")
    score = _score(mean, weight, base)
    # Held-out documents place the borders; only counts by step and level come to the driver. Without any, the clamped ones do.
    known = graph.where("held is not null") if graph.where("held is not null").take(1) else clamped.withColumn("held", F.col("level"))
    seen = known.select("key", "links", "held").mapInArrow(score, f"key {kind}, held double, score double")
    got = seen.groupBy(step(F.col("score")).alias("step"), F.round("held").cast("int").alias("rating")).count().collect()
    counts = np.zeros((STEPS, HIGHEST - LOWEST + 1))
    for r in got:
        counts[r.step, r.rating - LOWEST] += r["count"]
    out = graph.select("key", "links").mapInArrow(score, f"key {kind}, score double")
    passed = sum((step(F.col("score")) >= int(b)).cast("int") for b in borders(counts))
    return out.select(F.col("key").alias(key), "score", (F.lit(LOWEST) + passed).cast("int").alias("level"))


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score and level."""
    return reading_levels(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "doc_levels"), "doc_id", "reading_level", "rater", "r1")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_levels(spark, sf_dir).where("level >= 4").select("doc_id").distinct()


SQL: dict[str, str] = {}
QUERIES = {"p10_levels": p10_levels, "p10_found": p10_found}

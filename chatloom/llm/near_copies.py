"""Problem 6: near-duplicate records with small edits.

Count-vector R-tree: the distinct tokens (strings of adjacent characters) of a record are hashed into groups, and the counts per group
are the record's point. The overlap of two records is at most the sum of the coordinates' minima; for a node of the tree the coordinate
maxima of its points take the points' place. Pairs that the bound leaves are verified on their token sets.

The tree is grown apart in each partition of an exact distribution: a record is sent to the partitions of its rarest tokens, as many as
any partner must share one of. Counts are kept in unary (count >= 1, >= 2, >= 3; the excess is added to the bound), so that the sum of
minima is the number of bits two points share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import batches, materialize, table

#: Groups into which tokens are hashed: the tree's dimensions.
GROUPS = 128
LEVELS = 3
WORDS = GROUPS * LEVELS // 64
#: Buckets of the token frequencies by which tokens are ordered, rarest first. Any fixed order is right; rare first is fast. The driver
#: holds this many counts at most.
FREQUENCY_BITS = 20
#: Points in a leaf of the tree, and nodes in a node above.
LEAF, FAN = 32, 8
#: Entries of one token above which they are spread over a triangle of cells.
CELL = 1 << 15
#: Tokens of all records for each partition of entries.
PART_TOKENS = 1 << 22
#: Characters of texts taken apart at once, and pairs compared at once.
BLOCK_CHARS = 1 << 19
BLOCK_PAIRS = 1 << 18


def token_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of every text as 64-bit codes, text after text, and how many each has. Codes of up to three characters are exact."""
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    n = len(c) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    code = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            code = code * np.uint64(1 << 21) + c[k : k + n] if width <= 3 else (code * np.uint64(0x100000001B3)) ^ c[k : k + n]
    doc = np.repeat(np.arange(len(texts)), size)[:n]
    inside = np.arange(n) + width <= ends[doc]
    code, doc = code[inside], doc[inside]
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    if len(code):
        new = np.concatenate(([True], (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])))
        code, doc = code[new], doc[new]
    return code, np.bincount(doc, minlength=len(texts))


def _mixed(code: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def points(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unary count vectors (texts x WORDS words of 64 bits) and each text's excess beyond LEVELS."""
    n = len(sizes)
    doc = np.repeat(np.arange(n), sizes)
    group = (hashes % np.uint64(GROUPS)).astype(np.int64)
    count = np.bincount(doc * GROUPS + group, minlength=n * GROUPS).reshape(n, GROUPS)
    bits = np.concatenate([count > k for k in range(LEVELS)], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64), np.maximum(count - LEVELS, 0).sum(1)


def needed(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    """The least overlap of sets of sizes a and b with a similarity of t."""
    return np.ceil(t / (1 + t) * (a + b) - 1e-9)


def _frequencies(width: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << FREQUENCY_BITS, np.int64)
        for b in it:
            texts = b.column("text").to_pylist()
            for part in _parts(texts):
                code, _ = token_sets(texts[part], width)
                total += np.bincount((_mixed(code) >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64), minlength=len(total))
        used = np.flatnonzero(total)
        if len(used):
            yield pa.record_batch({"bucket": used.astype(np.int32), "n": total[used]})

    return run


def _parts(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


ENTRIES = "token long, side int, id long, size int, place int, excess int, point binary"


def _entries(width: int, t: float, frequency: np.ndarray):
    """A record's entries: one for each token of its prefix that another record may share."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, texts = b.column("id").to_numpy(), b.column("text").to_pylist()
            for part in _parts(texts):
                code, sizes = token_sets(texts[part], width)
                own = ids[part]
                h = _mixed(code)
                point, excess = points(h, sizes)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                often = frequency[(h >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)]
                order = np.lexsort((h, often, doc))
                h, often = h[order], often[order]
                place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                size = sizes[doc]
                # Of a set of size n any partner shares one of the n - ceil(t n) + 1 rarest tokens.
                use = (place <= size - np.ceil(t * size - 1e-9)) & (often > 1)
                h, doc, place, size, often = h[use], doc[use], place[use], size[use], often[use]
                token, side, pick = h.view(np.int64), np.zeros(len(h), np.int32), np.arange(len(h))
                cells = -(-often // CELL)
                if (cells > 1).any():
                    token, side, pick = _cells(h, own[doc], cells)
                data = pa.Array.from_buffers(pa.binary(), len(point), [None, pa.py_buffer((np.arange(len(point) + 1) * WORDS * 8).astype(np.int32).tobytes()), pa.py_buffer(point.tobytes())])
                at = doc[pick]
                for k in range(0, len(at), 1 << 15):
                    s = slice(k, k + (1 << 15))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(token[s]), pa.array(side[s]), pa.array(own[at[s]]), pa.array(size[pick[s]].astype(np.int32)), pa.array(place[pick[s]].astype(np.int32)), pa.array(excess[at[s]].astype(np.int32)), data.take(pa.array(at[s]))],
                        names=["token", "side", "id", "size", "place", "excess", "point"],
                    )

    return run


def _cells(h: np.ndarray, ids: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A frequent token's entries over the cells (i, j), i <= j < n: a record of salt s goes to all cells with s in them. In a cell with
    i < j only records of different sides (1 and 2) meet."""
    pick = np.repeat(np.arange(len(h)), cells)
    other = np.arange(len(pick)) - np.repeat(np.cumsum(cells) - cells, cells)
    salt = (_mixed(ids.astype(np.uint64))[pick] % cells[pick].astype(np.uint64)).astype(np.int64)
    low, high = np.minimum(salt, other), np.maximum(salt, other)
    side = np.where(low == high, 0, np.where(salt == low, 1, 2)).astype(np.int32)
    with np.errstate(over="ignore"):
        token = _mixed(h[pick] + low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + high.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return np.where(cells[pick] == 1, h[pick], token).view(np.int64), side, pick


class Entries:
    """Entries in the order of token and size. rest: the tokens of a record from the entry's token on, which bound what it can share if that
    is the first token shared."""

    def __init__(self, t: pa.Table):
        get = lambda n: t.column(n).to_numpy()
        self.token, self.side, self.id, self.size, self.excess = (get(n) for n in ("token", "side", "id", "size", "excess"))
        self.rest = self.size - get("place")
        self.point = np.frombuffer(b"".join(t.column("point").to_pylist()), np.uint64).reshape(-1, WORDS)

    def bounded(self, i: np.ndarray, j: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs i, j those whose bounds reach the needed overlap."""
        a, b = self.size[i], self.size[j]
        need = needed(a, b, t)
        ok = (np.minimum(a, b) >= t * np.maximum(a, b) - 1e-9) & (np.minimum(self.rest[i], self.rest[j]) >= need) & (self.id[i] != self.id[j])
        ok &= (self.side[i] != self.side[j]) | (self.side[i] == 0)
        i, j, need = i[ok], j[ok], need[ok]
        minima = np.bitwise_count(self.point[i] & self.point[j]).sum(1, dtype=np.int64) + np.minimum(self.excess[i], self.excess[j])
        ok = minima >= need
        return i[ok], j[ok]


class Nodes:
    """One level of a tree: of each node the coordinate maxima of its points (in unary: the bits any of them has), the greatest excess and
    rest, and the least and greatest size."""

    def __init__(self, point: np.ndarray, excess: np.ndarray, rest: np.ndarray, least: np.ndarray, most: np.ndarray, fan: int):
        at = np.arange(0, len(excess), fan)
        self.point = np.bitwise_or.reduceat(point, at, axis=0)
        self.excess, self.rest = np.maximum.reduceat(excess, at), np.maximum.reduceat(rest, at)
        self.least, self.most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)

    def above(self) -> Nodes:
        return Nodes(self.point, self.excess, self.rest, self.least, self.most, FAN)

    def reach(self, x: np.ndarray, y: np.ndarray, t: float) -> np.ndarray:
        """Of the pairs of nodes those of which two points may reach the needed overlap."""
        need = needed(self.least[x], self.least[y], t)
        ok = (np.minimum(self.rest[x], self.rest[y]) >= need) & (self.most[x] >= t * self.least[y] - 1e-9) & (self.most[y] >= t * self.least[x] - 1e-9)
        k = np.flatnonzero(ok)
        minima = np.bitwise_count(self.point[x[k]] & self.point[y[k]]).sum(1, dtype=np.int64) + np.minimum(self.excess[x[k]], self.excess[y[k]])
        return k[minima >= need[k]]


def _packed(e: Entries, lo: int, hi: int) -> np.ndarray:
    """The order of one token's entries in the leaves, by tiles: strips of like size, in which entries follow by their rest."""
    m = hi - lo
    strips = math.ceil(math.sqrt(-(-m // LEAF)))
    wide = -(-m // (strips * LEAF)) * LEAF
    return lo + np.lexsort((-e.rest[lo:hi], np.arange(m) // wide))


def _tree(e: Entries, lo: int, hi: int, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one token's entries through a tree: leaves of LEAF points, FAN nodes in each node above, walked against itself from the
    root down; only pairs of nodes that may hold a pair of points are opened."""
    order = _packed(e, lo, hi)
    size = e.size[order]
    levels = [Nodes(e.point[order], e.excess[order], e.rest[order], size, size, LEAF)]
    while len(levels[-1].least) > 1:
        levels.append(levels[-1].above())
    # Depth first in blocks, so that what is open at once stays bounded.
    todo = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    block = BLOCK_PAIRS // (LEAF * LEAF)
    while todo:
        k, x, y = todo.pop()
        keep = levels[k].reach(x, y, t)
        x, y = x[keep], y[keep]
        if k == 0:
            for s in range(0, len(x), block):
                i = x[s : s + block, None, None] * LEAF + np.arange(LEAF)[None, :, None]
                j = y[s : s + block, None, None] * LEAF + np.arange(LEAF)[None, None, :]
                i, j = np.broadcast_arrays(i, j)
                ok = (i < j) & (j < len(order))
                yield e.bounded(order[i[ok]], order[j[ok]], t)
            continue
        n = len(levels[k - 1].least)
        for s in range(0, len(x), BLOCK_PAIRS // (FAN * FAN)):
            part = slice(s, s + BLOCK_PAIRS // (FAN * FAN))
            i, j = np.broadcast_arrays(x[part, None, None] * FAN + np.arange(FAN)[None, :, None], y[part, None, None] * FAN + np.arange(FAN)[None, None, :])
            ok = (i <= j) & (j < n)
            todo.append((k - 1, i[ok], j[ok]))


def candidates(e: Entries, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of complete tokens. Tokens that fill no more than a leaf are worked side by side, the others by their trees."""
    n = len(e.token)
    start = np.flatnonzero(np.concatenate(([True], e.token[1:] != e.token[:-1])))
    length = np.diff(np.concatenate((start, [n])))
    end_of = np.repeat(start + length, length)
    small = np.repeat(length <= LEAF, length)
    rows = np.flatnonzero(small)
    for d in range(1, LEAF):
        rows = rows[rows + d < end_of[rows]]
        if not len(rows):
            break
        yield e.bounded(rows, rows + d, t)
    for s, m in zip(start[length > LEAF], length[length > LEAF]):
        yield from _tree(e, s, s + m, t)


def _join(t: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(x: pa.Table) -> pa.RecordBatch | None:
            e, out = Entries(x), []
            for i, j in candidates(e, t):
                if len(i):
                    out.append(np.stack((np.minimum(e.id[i], e.id[j]), np.maximum(e.id[i], e.id[j]))))
            if not out:
                return None
            pairs = np.unique(np.concatenate(out, axis=1), axis=1)
            return pa.record_batch({"a": pairs[0], "b": pairs[1]})

        rest = None
        for x in batches(it, 1 << 16):
            x = pa.concat_tables([rest, x]) if rest is not None else x
            token = x.column("token").to_numpy()
            cut = int(np.searchsorted(token, token[-1], side="left"))  # the last token may go on
            rest = x.slice(cut)
            if cut and (b := found(x.slice(0, cut))) is not None:
                yield b
        if rest is not None and (b := found(rest)) is not None:
            yield b

    return run


def similarities(left: list[str], right: list[str], width: int) -> np.ndarray:
    """Exact similarities of the token sets of texts side by side."""
    (x, nx), (y, ny) = token_sets(left, width), token_sets(right, width)
    _, dense = np.unique(np.concatenate((x, y)), return_inverse=True)
    pair = np.concatenate((np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)))
    key = np.sort((pair << 32) | dense)
    both = np.bincount(key[1:][key[1:] == key[:-1]] >> 32, minlength=len(nx)) if len(key) else np.zeros(len(nx))
    union = nx + ny - both
    return np.where(union > 0, both / np.maximum(union, 1), 0.0)


def _verify(width: int, t: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            left, right = b.column("text_a").to_pylist(), b.column("text_b").to_pylist()
            for part in _parts([x + y for x, y in zip(left, right)]):
                s = similarities(left[part], right[part], width)
                ok = np.flatnonzero(s >= t - 1e-12)
                if len(ok):
                    rows = pa.array(ok + part.start)
                    yield pa.RecordBatch.from_arrays([b.column("a").take(rows), b.column("b").take(rows), pa.array(s[ok])], names=["a", "b", "similarity"])

    return run


def near_copies(df: DataFrame, key: str, text: str, t: float = 0.8, width: int = 5, least_chars: int = 0) -> tuple[DataFrame, DataFrame]:
    """Classes of equal texts and the links between them.

    First table: ``key``, class_id (the smallest key of the class) of every row whose text has at least ``least_chars`` and at least
    ``width`` characters once white space is removed; texts equal after that are one class. Second table: a, b (class ids, a < b),
    similarity: the distinct strings of ``width`` adjacent characters in both, of those in either, where it reaches ``t``. No link between
    different texts is lost, and copies are not expanded. ``key`` is a bigint; rows with a null key or text are left out; repeated keys
    are kept in the first table. Texts are worked whole; other columns are ignored; an empty table gives two empty ones."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.regexp_replace(F.col(text), r"(?U)\s+", "").alias("text")).where(F.col("id").isNotNull() & (F.length("text") >= max(least_chars, width)))
    held = materialize(rows, "p6-rows")
    classes = materialize(held.groupBy("text").agg(F.min("id").alias("id")).select("id", "text"), "p6-classes")
    got = classes.mapInArrow(_frequencies(width), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(1 << FREQUENCY_BITS, np.int64)
    frequency[got["bucket"].to_numpy(int)] = got["n"].to_numpy(np.int64)
    # Sent once to every executor: at most 2^FREQUENCY_BITS counts of 4 bytes.
    shared = spark.sparkContext.broadcast(np.minimum(frequency, (1 << 31) - 1).astype(np.int32))

    def entries(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _entries(width, t, shared.value.astype(np.int64))(it)

    # A record has entries for a part of its tokens; their counted number keeps the partitions of a bounded size.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(frequency.sum()) // PART_TOKENS))
    routed = classes.mapInArrow(entries, ENTRIES).repartition(parts, "token").sortWithinPartitions("token", "size", "id")
    pairs = routed.mapInArrow(_join(t), "a long, b long").distinct()
    side = lambda s: classes.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))
    links = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, t), "a long, b long, similarity double")
    members = held.join(classes.withColumnRenamed("id", "class_id"), "text").select(F.col("id").alias(key), "class_id")
    return members, links


def _questions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return near_copies(table(spark, sf_dir, "robot_log"), "log_id", "question", t=0.6, width=3, least_chars=40)


def p6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between different questions."""
    return _questions(spark, sf_dir)[1].withColumn("similarity", F.round("similarity", 9))


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of equal questions of every row."""
    return _questions(spark, sf_dir)[0]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows, as TESTDATA.md asks: links expanded to the classes' rows, and equal questions."""
    members, links = _questions(spark, sf_dir)
    links = links.select("a", "b")
    left, right = members.select(F.col("class_id").alias("a"), F.col("log_id").alias("x")), members.select(F.col("class_id").alias("b"), F.col("log_id").alias("y"))
    between = links.join(left, "a").join(right, "b").select("x", "y")
    within = left.join(right, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    return between.unionByName(within).select(F.least("x", "y").alias("log_id_a"), F.greatest("x", "y").alias("log_id_b"))


_SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_CLASSED = f"""r as (select log_id, regexp_replace(question, '{_SPACE}', '', 'g') as x from robot_log where question is not null),
      s as (select log_id, x, min(log_id) over (partition by x) as c from r where length(x) >= 40)"""
_SHARED = f"""{_CLASSED}, g as (select c, unnest(list_distinct(list_transform(range(1, length(x) - 1), lambda i: substr(x, i, 3)))) as g from (select distinct c, x from s)),
      n as (select c, count(*) as n from g group by 1), b as (select l.c as a, r.c as b, count(*) as k from g l join g r on l.g = r.g and l.c < r.c group by 1, 2),
      p as (select a, b, k::double / (x.n + y.n - k) as similarity from b join n x on x.c = a join n y on y.c = b where k * 10 >= 6 * (x.n + y.n - k))"""
SQL = {
    "p6_classes": f"with {_CLASSED} select log_id, c as class_id from s",
    "p6_links": f"with {_SHARED} select a, b, round(similarity, 9) as similarity from p",
    "p6_found": f"""with {_SHARED}, e as (select a, b from p union all select distinct c, c from s)
      select distinct least(l.log_id, r.log_id) as log_id_a, greatest(l.log_id, r.log_id) as log_id_b from e join s l on l.c = a join s r on r.c = b where l.log_id <> r.log_id""",
}
QUERIES = {"p6_links": p6_links, "p6_classes": p6_classes, "p6_found": p6_found}

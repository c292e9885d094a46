"""Problem 9: evaluation texts leaking into training text.

Q-gram lemma filtering: a passage of at least L characters that matches a test item within e edits shares at least L - q + 1 - e * q of its
q-grams with it, in a band of diagonals no wider than e + 1. Of the items' q-grams every s-th is indexed, and the bound is that of these:
(L - q + 1) / s - e * q / s, rounded down and up. Shared q-grams are counted in overlapping diagonal bands, the regions that reach the bound
are kept, and each is verified by banded alignment. Hits are worked in slices of a bounded number, however often a q-gram is repeated.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import BROADCAST_BYTES, batches, scratch_path, table

#: Length of a q-gram, a power of two; the bound L - q + 1 - e * q must stay positive.
Q = 16
#: Characters of documents looked at together in a task.
BLOCK_CHARS = 1 << 21
#: Bytes of test items indexed at once: more are worked in blocks, each against all documents.
ITEM_BYTES = BROADCAST_BYTES
#: Shared q-grams held at once in a task, and cells of alignments.
HITS = 1 << 19
CELLS = 1 << 22
BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 22


def _kept() -> np.ndarray:
    """For every code point, whether it is a letter or a number."""
    return np.array([unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)], bool)


_TABLE: list[np.ndarray] = []


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The compared characters (NFKC, lower case, letters and numbers only) of all texts in one array, and each text's end in it."""
    if not _TABLE:
        _TABLE.append(_kept())
    even = [unicodedata.normalize("NFKC", t).lower() for t in texts]
    codes = np.frombuffer("".join(even).encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = _TABLE[0][codes]
    ends = np.cumsum([len(t) for t in even])
    kept = np.concatenate(([0], np.cumsum(keep)))[ends] if len(codes) else np.zeros(len(texts), np.int64)
    return codes[keep], kept.astype(np.int64)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Rolling hashes of all q-grams by doubling: a hash of 2k characters from two of k."""
    h, width, power = codes.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(1), 1, BASE
    with np.errstate(over="ignore"):
        while width < q:
            h = h[:-width] * power + h[width:] if len(h) > width else h[:0]
            power, width = power * power, width * 2
    return h


def stride(length: int, edits: int, q: int) -> tuple[int, int]:
    """Every how many q-grams of an item are indexed, and how many of these a passage shares at least."""
    best = (1, length - q + 1 - edits * q)
    for s in range(2, 9):
        need = (length - q + 1) // s - edits * -(-q // s)
        if need >= 2:
            best = (s, need)
    return best


class Items:
    """The q-gram index of a block of test items: every ``step``-th q-gram of each."""

    def __init__(self, ids: list, texts: list[str], q: int, step: int = 1):
        self.ids, self.q = ids, q
        self.codes, ends = letters(texts)
        self.ends, self.starts = ends, np.concatenate(([0], ends[:-1])) if len(ends) else ends
        h = gram_hashes(self.codes, q)
        at = np.arange(len(h))
        of = np.searchsorted(self.ends, at, side="right")
        at = at[(at + q <= self.ends[of]) & ((at - self.starts[of]) % step == 0)] if len(h) else at
        self.hashes, rank = np.unique(h[at], return_inverse=True)
        # Places of the q-grams in the order of their hash and place, in one number: a hash's places in any range of the items are a range.
        self.span = len(self.codes) + 1
        self.keys = np.sort(rank.astype(np.int64) * self.span + at)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the documents whose q-gram is indexed, and the numbers of these q-grams."""
        at = np.flatnonzero(self.filter[self._slot(h)])
        rank = np.searchsorted(self.hashes, h[at])
        ok = rank < len(self.hashes)
        ok[ok] = self.hashes[rank[ok]] == h[at][ok]
        return at[ok], rank[ok]

    def counts(self, rank: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """For each q-gram where its places in the items' range [low, high) begin, and how many they are."""
        first = np.searchsorted(self.keys, rank * self.span + low)
        return first, np.searchsorted(self.keys, rank * self.span + high) - first

    def places(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.keys[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())] % self.span


def _slices(items: Items, at: np.ndarray, rank: np.ndarray, reach: int, wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hits (positions in the documents and in the items) in slices of about ``HITS``. Slices overlap by ``reach``, so that each passage lies
    in one. ``wanted`` tells of a range of positions and of items whether it is still of interest."""
    todo = [(0, len(at), 0, len(items.codes))]
    while todo:
        lo, hi, low, high = todo.pop()
        if lo >= hi or not wanted(at[lo], at[hi - 1], low, high):
            continue
        first, n = items.counts(rank[lo:hi], low, high)
        total = int(n.sum())
        if not total:
            continue
        middle = lo + (hi - lo) // 2
        right = int(np.searchsorted(at, at[middle - 1] - reach + 1)) if hi - lo > 1 else lo
        if total > HITS and right > lo:
            todo += [(right, hi, low, high), (lo, middle, low, high)]
        elif total > HITS and high - low > 4 * reach:
            cut = (low + high) // 2
            todo += [(lo, hi, max(low, cut - reach), high), (lo, hi, low, cut)]
        else:
            yield np.repeat(at[lo:hi], n), items.places(first, n)


def longest_runs(same: np.ndarray) -> np.ndarray:
    """The longest run of true cells in each row."""
    place = np.arange(1, same.shape[1] + 1)
    gap = np.maximum.accumulate(np.where(same, 0, place), axis=1)
    return (place - gap).max(axis=1, initial=0)


def _window(codes: np.ndarray, start: np.ndarray, width: int, low: np.ndarray, high: np.ndarray, empty: int) -> np.ndarray:
    """Codes from ``start`` on in each row; ``empty`` outside [low, high)."""
    at = start[:, None] + np.arange(width)
    inside = (at >= low[:, None]) & (at < high[:, None])
    return np.where(inside, codes[np.where(inside, at, 0)].astype(np.int64), empty)


def aligned(x: np.ndarray, y: np.ndarray, length: int, edits: int, band: int) -> np.ndarray:
    """Banded alignment of windows side by side (rows of codes, negative where there is none): whether a run of at least ``length``
    characters of one matches a run of the other within ``edits`` edits, on diagonals from -band to band of the windows (y's window begins
    ``band`` characters earlier than x's)."""
    if not edits:
        return longest_runs((x == y[:, band : band + x.shape[1]]) & (x >= 0)) >= length
    return _reaches(x, y, length, edits, band, True) | _reaches(x, y, length, edits, band, False)


def _reaches(x: np.ndarray, y: np.ndarray, length: int, edits: int, band: int, of_x: bool) -> np.ndarray:
    """aligned, with the run's length counted in characters of x or of y. best[k][:, d]: the length of the longest run that ends before
    x's next character on diagonal d with k edits; -1 where there is none."""
    n, size, width = len(x), x.shape[1], 2 * band + 1
    found = np.zeros(n, bool)
    best = np.zeros((edits + 1, n, width), np.int32)  # a run may begin anywhere
    for i in range(size):
        here = y[:, i : i + width]
        ink, other = (x[:, i] >= 0)[:, None], here >= 0
        same = (x[:, i : i + 1] == here) & ink
        new = np.zeros_like(best)
        for k in range(edits + 1):
            row = np.where(same, best[k] + 1, 0)
            if k:
                swapped = np.where(ink & other, best[k - 1] + 1, 0)
                left_out = np.zeros_like(row)  # a character of x without one of y: the diagonal falls by one
                left_out[:, :-1] = np.where(ink, best[k - 1][:, 1:] + of_x, 0)
                row = np.maximum(row, np.maximum(swapped, left_out))
            if k:
                put_in = np.zeros_like(row)  # a character of y without one of x: the diagonal rises by one, at the same place of x
                put_in[:, 1:] = np.where(here[:, 1:] >= 0, new[k - 1][:, :-1] + (not of_x), 0)
                row = np.maximum(row, put_in)
            new[k] = row
            found |= row.max(axis=1) >= length
        best = new
    return found


def find_leaks(items: Items, texts: list[str], length: int, edits: int, need: int | None = None) -> set[tuple[int, int]]:
    """(text, item) numbers of the pairs that share a passage. ``need``: the indexed q-grams that a passage shares at least."""
    q = items.q
    need = length - q + 1 - edits * q if need is None else need
    codes, ends = letters(texts)
    if len(codes) < q or not len(items.hashes):
        return set()
    starts = np.concatenate(([0], ends[:-1]))
    at, rank = items.known(gram_hashes(codes, q))
    inside = at + q <= ends[np.searchsorted(ends, at, side="right")]
    at, rank = at[inside], rank[inside]
    width, reach = 2 * edits + 1, length + 2 * edits
    found: set[tuple[int, int]] = set()

    def wanted(first: int, last: int, low: int, high: int) -> bool:
        """False for a slice of one text and one item that are known to share a passage."""
        d, i = np.searchsorted(ends, [first, last], side="right"), np.searchsorted(items.ends, [low, high - 1], side="right")
        return d[0] != d[1] or i[0] != i[1] or (int(d[0]), int(i[0])) not in found

    for p, o in _slices(items, at, rank, reach, wanted):
        doc, item = np.searchsorted(ends, p, side="right"), np.searchsorted(items.ends, o, side="right")
        diagonal = (p - starts[doc]) - (o - items.starts[item])
        # Bands of twice the width that overlap by half, so that every run of `width` diagonals lies in one.
        for offset in range(2 if edits else 1):
            band = (diagonal + offset * width) // (2 * width) if edits else diagonal
            order = np.lexsort((p, band, item, doc))
            d, i, b, at_, other = doc[order], item[order], band[order], p[order], o[order]
            # Regions where `need` shared q-grams lie within one passage's reach.
            k = np.arange(len(d) - need + 1)
            e = k + need - 1
            k = k[(d[k] == d[e]) & (i[k] == i[e]) & (b[k] == b[e]) & (at_[e] - at_[k] <= reach - q)]
            # A passage is in reach of its first region, so of regions that follow within a quarter one is enough.
            if len(k):
                gap = np.concatenate(([True], (np.diff(at_[k]) != 0) | (np.diff(d[k]) != 0) | (np.diff(i[k]) != 0) | (np.diff(b[k]) != 0)))
                k = k[gap]
            wide = 2 * width + edits if edits else 0
            size = 3 * reach
            step = max(1, CELLS // (size * (1 if not edits else 4 * wide)))
            for m in range(0, len(k), step):
                c = k[m : m + step]
                fresh = np.array([(x, y) not in found for x, y in zip(d[c].tolist(), i[c].tolist())], bool)
                c = c[fresh]
                if not len(c):
                    continue
                start = at_[c] - reach
                x = _window(codes, start, size, starts[d[c]], ends[d[c]], -1)
                y = _window(items.codes, other[c] - reach - wide, size + 2 * wide, items.starts[i[c]], items.ends[i[c]], -2)
                ok = aligned(x, y, length, edits, wide)
                found |= set(zip(d[c][ok].tolist(), i[c][ok].tolist()))
    return found


def _search(source: str, block: int, length: int, edits: int, q: int, names: list[str], kinds: list[pa.DataType]):
    """Documents against one block of the written items, which each task reads from the shared folder."""
    kept: list[Items] = []
    step, need = stride(length, edits, q)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            import pyarrow.dataset as ds
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(f"{source}/block={block}")
            t = ds.dataset(path, format="parquet", filesystem=system).to_table(columns=["k", "t"])
            kept.append(Items(t.column("k").to_pylist(), t.column("t").to_pylist(), q, step))
        ids = kept[0].ids
        for t in batches(it, 1024):
            keys, bodies = t.column(0), t.column(1).to_pylist()
            rows, cols, start, size = [], [], 0, 0
            for k in range(len(bodies) + 1):
                if k == len(bodies) or size >= BLOCK_CHARS:
                    for d, i in sorted(find_leaks(kept[0], bodies[start:k], length, edits, need)):
                        rows.append(start + d)
                        cols.append(ids[i])
                    start, size = k, 0
                if k < len(bodies):
                    size += len(bodies[k])
            if rows:
                yield from pa.table([keys.take(pa.array(rows)).cast(kinds[0]), pa.array(cols, kinds[1])], names=names).to_batches()

    return run


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, length: int = 40, edits: int = 0, q: int = Q) -> DataFrame:
    """Pairs ``key``, ``item_key`` of documents and test items that share a run of at least ``length`` compared characters, within ``edits``.

    Compared are the texts in NFKC and lower case with only letters and numbers left, whole at any length. Null and empty texts match
    nothing; rows with repeated ids each give their rows; other columns are ignored, whatever their names; either table may be empty. Test
    items are written to the shared folder in blocks of about ``ITEM_BYTES`` (a longer item is a block of its own size); every block is
    held against all documents, and none passes through the driver."""
    if length - q + 1 - edits * q < 1:
        raise ValueError("q is too long for the length and the edits: no shared q-gram is certain")
    spark = docs.sparkSession
    kinds = [docs.schema[key].dataType, items.schema[item_key].dataType]
    schema = f"{key} {kinds[0].simpleString()}, {item_key} {kinds[1].simpleString()}"
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(k) for k in kinds]
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).where("_t <> ''")
    held = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).where("t <> ''")
    size = held.agg(F.sum(F.length("t") * 4)).first()[0]
    if not size:
        return spark.createDataFrame([], schema)
    n = -(-size // ITEM_BYTES)
    path = scratch_path(spark, "p9-items")
    held.withColumn("block", F.pmod(F.xxhash64("k", "t"), F.lit(n))).repartition("block").write.partitionBy("block").parquet(path)
    out = None
    for block in sorted(r.block for r in spark.read.parquet(path).select("block").distinct().collect()):  # block numbers
        found = rows.mapInArrow(_search(path, block, length, edits, q, [key, item_key], arrow), schema)
        out = found if out is None else out.unionByName(found)
    return out


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text").distinct()


SQL: dict[str, str] = {}
QUERIES = {"p9_found": p9_found}

"""Pairs of like texts of a group, worked out where the texts are: a group's texts are cut into blocks, a cell holds two of them, and its task
tests all its pairs on signatures, works out the distance of those that are left, and gives only pairs of numbers that are like enough.

So no candidate pair is exchanged or written: each text is sent to as many cells as its group has blocks, and each pair comes once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions import similarity as sm

#: Texts of a block.
BLOCK = 1 << 13
#: Words of a signature, 64 bits each; of one of pairs of neighbouring characters, which only pairs of texts that are left by the first meet.
WORDS, MORE_WORDS = 4, 16
#: Rows tested at once, pairs whose distances are worked out at once, and numbers of a table that these may take.
STEP, PAIRS, ROOM = 32, 1 << 13, 1 << 22
#: Pairs held until their distances are worked out, and rows of a group whose pairs are all written down at once with those of others.
HELD, SMALL = 1 << 17, 256


class Texts:
    """Texts end to end as character codes: where each begins, and its length."""

    def __init__(self, texts: pa.Array):
        data = "".join(texts.to_pylist())
        self.size = np.array([len(x) for x in texts.to_pylist()], np.int64)
        self.flat = np.frombuffer(data.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.start = np.cumsum(self.size) - self.size

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.size)), self.size)

    def keep(self, kept: np.ndarray) -> Texts:
        """The texts without the characters that aren't kept."""
        out = object.__new__(Texts)
        out.flat, out.size = self.flat[kept], np.bincount(self.rows()[kept], minlength=len(self.size)).astype(np.int64)
        out.start = np.cumsum(out.size) - out.size
        return out

    def with_any(self, chars: str) -> np.ndarray:
        return np.bincount(self.rows()[np.isin(self.flat, [ord(c) for c in chars])], minlength=len(self.size)) > 0

    def padded(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), max(1, int(self.size[at].max()))), np.uint32)
        size = self.size[at]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(np.arange(len(at)), size), place] = self.flat[np.repeat(self.start[at], size) + place]
        return out


def bag_codes(row: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and numbers of items told apart by their occurrence: the n-th of its kind in its row."""
    order = np.lexsort((item, row))
    row, item = row[order], item[order].astype(np.uint64)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    first = np.flatnonzero(new)
    nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    return row, (item << np.uint64(32)) | nth.astype(np.uint64)


def signatures(row: np.ndarray, code: np.ndarray, n: int, words: int) -> np.ndarray:
    """64 * words bits for each row, of which each of its items sets one."""
    h = code * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    bits = np.zeros((n, 64 * words), np.uint8)
    bits[row, (h >> np.uint64(40)).astype(np.int64) % (64 * words)] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


class Bound:
    """Pairs of rows whose items may differ by a given number: that many of either side at most are lacking in the other. Of two signatures
    this is half of the unlike bits and of the difference of their sums, no more than of the items themselves."""

    def __init__(self, row: np.ndarray, code: np.ndarray, items: np.ndarray, order: np.ndarray, words: int = WORDS):
        signs = signatures(row, code, len(items), words)[order]
        self.columns = [np.ascontiguousarray(signs[:, k]) for k in range(words)]
        self.ones, self.items = np.bitwise_count(signs).sum(1).astype(np.int16), items[order].astype(np.int32)

    def test(self, a, b, spare: np.ndarray) -> np.ndarray:
        """a, b: places that are broadcast against each other."""
        unlike = np.abs(self.ones[a] - self.ones[b])
        for c in self.columns:
            unlike += np.bitwise_count(c[a] ^ c[b])
        return (unlike <= 2 * spare) & (np.abs(self.items[a] - self.items[b]) <= spare)


def distances(texts: Texts, bare: Texts, odd: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Weighted edit distances of pairs of rows, NaN where they are seen to exceed ``most``. bare: the texts without free characters, which
    cost nothing to lose or to get and one to replace; so where nothing is dear, distances are those of the bare texts at a cost of 1 each,
    worked out in words of 64 characters (Myers, Hyyrö). ``odd`` texts have characters of other costs, none of them less: theirs are no less
    than that, and those that may be near take the plain recurrence."""
    out = np.empty(len(a), np.float32)
    swap = bare.size[a] > bare.size[b]
    short, long = np.where(swap, b, a), np.where(swap, a, b)
    order = np.lexsort((short, (bare.size[short] + 63) // 64))
    low = 0
    while low < len(order):
        widest = np.maximum.accumulate(np.maximum(bare.size[long[order[low : low + PAIRS]]], 1))
        some = order[low : low + max(1, int(np.searchsorted(widest * np.arange(1, len(widest) + 1), ROOM)))]
        out[some] = _in_words(bare, short[some], long[some])
        low += len(some)
    out[out > most] = np.nan
    left = np.flatnonzero((odd[a] | odd[b]) & ~np.isnan(out))
    # Pairs of like lengths together, so that no long text widens all others.
    left = left[np.lexsort((texts.size[b[left]], texts.size[a[left]]))]
    string = lambda r: texts.flat[texts.start[r] : texts.start[r] + texts.size[r]].tobytes().decode("utf-32-le", "surrogatepass")
    low = 0
    while low < len(left):
        some = left[low : low + 2048]
        room = np.maximum.accumulate((texts.size[a[some]] + 1) * (texts.size[b[some]] + 1))
        some = some[: max(1, int(np.searchsorted(room * np.arange(1, len(room) + 1), 1 << 20)))]
        out[some] = sm.edit_distances([string(r) for r in a[some]], [string(r) for r in b[some]])
        low += len(some)
    return out


def _in_words(texts: Texts, short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Plain edit distances, the shorter text of each pair in the bits of words and a step for each character of the longer one."""
    order = np.argsort(-texts.size[long], kind="stable")
    mine, row = np.unique(short[order], return_inverse=True)
    codes, size = texts.padded(mine), texts.size[mine]
    words = max(1, -(-codes.shape[1] // 64))
    wide, steps = texts.padded(long[order]), texts.size[long[order]]
    known = np.unique(codes)
    kinds = len(known) + 1  # the last stands for a character that none of the shorter texts has
    local_of = np.full(int(max(codes.max(), wide.max())) + 1, len(known), np.int32)
    local_of[known] = np.arange(len(known))
    local = local_of[codes]
    local[np.arange(codes.shape[1])[None, :] >= size[:, None]] = len(known)
    masks = np.zeros((words, len(mine), kinds), np.uint64)
    every = np.arange(len(mine))
    for p in range(codes.shape[1]):
        masks[p // 64, every, local[:, p]] |= np.uint64(1 << (p % 64))
    masks[:, :, len(known)] = 0
    other = np.ascontiguousarray(local_of[wide].T)
    m = size[row]
    last = [np.where((m > 64 * w) & (m <= 64 * w + 64), np.uint64(1) << ((m - 1) % 64).astype(np.uint64), np.uint64(0)) for w in range(words)]
    score = m.astype(np.int32)
    up, down = [np.full(len(m), ~np.uint64(0)) for _ in range(words)], [np.zeros(len(m), np.uint64) for _ in range(words)]
    one, top = np.uint64(1), np.uint64(63)
    for j in range(int(steps[0]) if len(steps) else 0):
        k = int(np.searchsorted(-steps, -j, side="left"))  # pairs with a character left
        more, less = one, np.uint64(0)
        for w in range(words):
            eq, pv, mv = masks[w][row[:k], other[j, :k]], up[w][:k], down[w][:k]
            xv = eq | mv
            eq |= less
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            score[:k] += (ph & last[w][:k] != 0).view(np.int8)
            score[:k] -= (mh & last[w][:k] != 0).view(np.int8)
            more_next, less_next = ph >> top, mh >> top
            ph, mh = (ph << one) | more, (mh << one) | less
            up[w][:k], down[w][:k] = mh | ~(xv | ph), ph & xv
            more, less = more_next, less_next
    score = np.where(m == 0, steps, score)
    out = np.empty(len(m), np.float32)
    out[order] = score
    return out


def edit_similar(texts: Texts, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """As ``similarity.edit_similar`` in its floats; NaN for two empty texts."""
    na, nb = texts.size[a], texts.size[b]
    longest, least = np.maximum(na, nb), np.minimum(na, nb)
    with np.errstate(invalid="ignore"):
        ratio = (distance.astype(np.float64) / longest).astype(np.float32)
    factor = np.where((longest >= sm.LONG) & (longest > 2 * least), 0.5, 1.0)
    return (np.float32(1) - ratio).astype(np.float64) * factor


def _overlaps(row: np.ndarray, code: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common items by all items of each pair. row, code: the rows' items in order of the rows."""
    _, item = np.unique(code, return_inverse=True)
    start, kinds = np.cumsum(size) - size, int(item.max()) + 1 if len(item) else 1
    out = np.empty(len(a))
    for low in range(0, len(a), PAIRS):
        x, y = a[low : low + PAIRS], b[low : low + PAIRS]
        mine, at = np.unique(x, return_inverse=True)
        common = np.zeros(len(x), np.int64)
        step = max(1, (1 << 25) // kinds)
        for part in range(0, len(mine), step):
            some = mine[part : part + step]
            has = np.zeros((len(some), kinds), bool)
            n = size[some]
            place = np.repeat(start[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            has[np.repeat(np.arange(len(some)), n), item[place]] = True
            pick = np.flatnonzero((at >= part) & (at < part + step))
            n = size[y[pick]]
            place = np.repeat(start[y[pick]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            met = has[np.repeat(at[pick] - part, n), item[place]]
            common[pick] = np.bincount(np.repeat(np.arange(len(pick)), n), met, len(pick))
        out[low : low + PAIRS] = common / (size[x] + size[y] - common)
    return out


class Cell:
    """Rows of texts whose pairs are looked for: those whose edit similarity reaches t, or the overlap of whose words as multisets does
    where these are given; the greater of both is the pair's similarity.

    Within k = (1 - t) * length edits of the longer text no more than k costly characters of either text are lacking in the other, nor
    more than 2 k of its pairs of neighbours."""

    def __init__(self, text: pa.Array, t: float, words: pa.Array | None = None):
        self.t, self.texts, self.words = t, Texts(text), words
        self.bare = self.texts.keep(~np.isin(self.texts.flat, [ord(c) for c in sm.FREE]))
        self.odd = self.texts.with_any(sm.DEAR + "".join(sm.SPECIAL_REPLACE))
        # Longest first, so that the first row of a pair is the longer text.
        self.order = np.argsort(-self.texts.size, kind="stable")
        self.size = self.texts.size[self.order]
        self.spare = np.floor((1 - t) * self.size + 1e-6).astype(np.int32)
        self.chars = Bound(*bag_codes(self.bare.rows(), self.bare.flat), self.bare.size, self.order)
        # An edit costs a text two of its pairs of neighbouring characters at most, and brings two.
        flat, rows = self.bare.flat.astype(np.uint64), self.bare.rows()
        inner = rows[1:] == rows[:-1]
        grams = ((flat[:-1] * np.uint64(2654435761) + flat[1:]) & np.uint64(0xFFFFFFFF))[inner]
        self.grams = Bound(*bag_codes(rows[1:][inner], grams), np.maximum(self.bare.size - 1, 0), self.order, MORE_WORDS)
        if words is not None:
            _, item = np.unique(np.asarray(words.flatten().to_pylist(), dtype=str), return_inverse=True)
            self.number = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            self.code = bag_codes(np.repeat(np.arange(len(self.number)), self.number), item)
            self.said = Bound(*self.code, self.number, self.order)
            self.lost = ((1 - t) / (1 + t) * self.number[self.order] + 1e-3).astype(np.float32)

    def _worded(self, a, b) -> np.ndarray:
        """Of an overlap t the words of one text alone are no more than (1 - t) / (1 + t) of both texts' words."""
        most, items = self.lost[a] + self.lost[b], self.said.items
        unlike = np.zeros(most.shape, np.int16)
        for c in self.said.columns:
            unlike += np.bitwise_count(c[a] ^ c[b])
        return (unlike <= most) & (np.abs(items[a] - items[b]) <= most)

    def _near(self, a, b) -> np.ndarray:
        near = self.chars.test(a, b, self.spare[a])
        return near if self.words is None else near | self._worded(a, b)

    def _scored(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sim = np.full(len(a), np.nan)
        at = np.flatnonzero(self.chars.test(a, b, self.spare[a]))
        at = at[self.grams.test(a[at], b[at], 2 * self.spare[a[at]])]
        x, y = self.order[a[at]], self.order[b[at]]
        sim[at] = edit_similar(self.texts, x, y, distances(self.texts, self.bare, self.odd, x, y, self.spare[a[at]]))
        if self.words is not None:
            at = np.flatnonzero(self._worded(a, b))
            sim[at] = np.fmax(sim[at], _overlaps(*self.code, self.number, self.order[a[at]], self.order[b[at]]))
        good = sim >= self.t
        return self.order[a[good]], self.order[b[good]], sim[good]

    def pairs(self, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows and similarity of the pairs, some at a time. side: only pairs of the one with the other side."""
        side = None if side is None else side[self.order]
        # What is near to a text by its characters is no shorter than the costly ones that are left of it.
        stop = np.searchsorted(-self.size, self.spare - self.chars.items, side="right")
        held, n, total = [], 0, len(self.size)
        for low in range(0, total, STEP):
            high = min(total, low + STEP)
            rows = np.arange(low, high)[:, None]
            last = total if self.words is not None else max(int(stop[low:high].max()), high)
            for left in range(low, last, BLOCK):
                columns = np.s_[None, left : min(last, left + BLOCK)]
                near = self._near(np.s_[low:high, None], columns)
                if left < high:
                    near &= np.arange(left, min(last, left + BLOCK))[None, :] > rows
                if side is not None:
                    near &= side[low:high, None] != side[None, left : min(last, left + BLOCK)]
                i, j = np.nonzero(near)
                if len(i):
                    held.append((i + low, j + left))
                    n += len(i)
            if n >= HELD or (high == total and n):
                yield self._scored(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
                held, n = [], 0

    def pairs_within(self, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same of the pairs within small groups, whose numbers are given in falling or rising order."""
        place = np.argsort(group[self.order], kind="stable")  # longest first in each group
        _, n = np.unique(group, return_counts=True)
        after = np.repeat(np.cumsum(n), n) - 1 - np.arange(len(group))
        a = np.repeat(np.arange(len(group)), after)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
        a, b = place[a], place[b]
        near = self._near(a, b)
        if near.any():
            yield self._scored(a[near], b[near])


def in_cells(rows: DataFrame, t: float, words: bool = False) -> DataFrame:
    """Pairs of like texts of a group, each once: g, i, j, sim. rows: g and id (long), x, and with ``words`` an array of them."""
    spark = rows.sparkSession
    large = rows.groupBy("g").agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK).withColumn("_blocks", F.ceil(F.col("_n") / BLOCK)).drop("_n")
    cut = rows.join(F.broadcast(large), "g", "left")  # one row for each BLOCK texts at most
    cut = cut.withColumn("_block", F.when(F.col("_blocks").isNotNull(), F.pmod(F.xxhash64("id"), "_blocks")).otherwise(0))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_blocks", F.lit(1)).cast("long") - 1)))
    cut = cut.select("g", F.least("_block", "_other").cast("int").alias("p"), F.greatest("_block", "_other").cast("int").alias("q"), (F.col("_block") > F.col("_other")).alias("second"), "id", "x", *(["words"] if words else []))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(parts, "g", "p", "q").sortWithinPartitions("g", "p", "q").mapInArrow(_cells(t, words), "g long, i long, j long, sim double")


def runs(it: Iterator[pa.RecordBatch], columns: list[str], least: int) -> Iterator[pa.Table]:
    """Rows ordered by ``columns`` (numbers): tables of whole runs of equal ones, of ``least`` rows or one run."""
    held, n = [], 0
    for b in it:
        if not b.num_rows:
            continue
        now = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in columns])
        begins = np.flatnonzero(np.concatenate(([True], (now[:, 1:] != now[:, :-1]).any(0))))
        if held and all(held[-1].column(c)[held[-1].num_rows - 1].as_py() == b.column(c)[0].as_py() for c in columns):
            begins = begins[1:]
        done = 0
        for k, at in enumerate(begins):
            end = begins[k + 1] if k + 1 < len(begins) else b.num_rows
            # A run begins here: what came before is whole, and goes if it is enough or the run is long.
            if n + at - done and (n + at - done >= least or end - at >= least):
                yield pa.Table.from_batches([*held, b.slice(done, at - done)])
                held, n, done = [], 0, at
        held.append(b.slice(done))
        n += b.num_rows - done
    if n:
        yield pa.Table.from_batches(held)


def _cells(t: float, words: bool):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(it, ["g", "p", "q"], SMALL):
            part = part.combine_chunks()
            g, p, q, second, ids = (part.column(c).to_numpy() for c in ("g", "p", "q", "second", "id"))
            edges = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]), [True])))
            small = np.repeat(np.diff(edges) <= SMALL, np.diff(edges))
            made = []
            take = lambda at: Cell(part.column("x").combine_chunks().take(at), t, part.column("words").combine_chunks().take(at) if words else None)
            whole = np.flatnonzero(small & (p == q))
            if len(whole):
                made.append((whole, take(pa.array(whole)).pairs_within(g[whole])))
            for low, high in zip(edges[:-1], edges[1:]):
                if high - low > 1 and not (small[low] and p[low] == q[low]):
                    at = np.arange(low, high)
                    made.append((at, take(pa.array(at)).pairs(second[low:high] if p[low] != q[low] else None)))
            for at, found in made:
                for i, j, sim in found:
                    i, j = at[i], at[j]
                    yield pa.RecordBatch.from_arrays([pa.array(g[i]), pa.array(ids[i]), pa.array(ids[j]), pa.array(sim)], names=["g", "i", "j", "sim"])

    return run

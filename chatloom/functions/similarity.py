"""Similarity of questions: weighted edit distance, token overlaps and their combination.

The edit distance runs as an Arrow UDF that works on all pairs of a batch at once (vectorized over pairs, one pass per character of the
shorter dimension); the same recurrence as a pure expression serves as a cross-check. Ratios are rounded to 32-bit floats where the rules say so.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Costs and thresholds.
FREE = "的 最和"
DEAR, DEAR_COST = "不", 5.0
SPECIAL_REPLACE, SPECIAL_COST = ("C", "G"), 2.0
LONG = 8
MODEL = r"[a-zA-Z0-9]+[-|_][a-zA-Z0-9]+"
MIXED = r"([a-zA-Z]+[0-9]+\w*)|([0-9]+[a-zA-Z]+\w*)"
WORD_RUN = r"\w+"


def _codes(texts: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), np.uint32)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _costs(codes: np.ndarray) -> np.ndarray:
    cost = np.ones(codes.shape, np.float32)
    for c in FREE:
        cost[codes == ord(c)] = 0
    cost[codes == ord(DEAR)] = DEAR_COST
    return cost


def _least_distances(ca: np.ndarray, cb: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> np.ndarray:
    """A lower bound of distances: the characters that cost something in one text beyond those in the other, counted by hash."""

    def counts(codes: np.ndarray, cost: np.ndarray) -> np.ndarray:
        slot = (codes * np.uint32(2654435761)) >> np.uint32(26)
        at = np.arange(len(codes))[:, None] * 64 + slot
        return np.bincount(at[(codes > 0) & (cost > 0)], minlength=len(codes) * 64).reshape(-1, 64)

    more = counts(ca, wa) - counts(cb, wb)
    return np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1))


def edit_distances(a: list[str], b: list[str], share: float | None = None) -> np.ndarray:
    """Weighted distances of texts side by side. With ``share`` NaN stands where a bound shows more than that share of the longer length."""
    if not a:
        return np.empty(0, np.float32)
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    ca, cb = _codes(a, max(1, na.max())), _codes(b, max(1, nb.max()))
    wa, wb = _costs(ca), _costs(cb)
    if share is not None:
        near = _least_distances(ca, cb, wa, wb) <= share * np.maximum(na, nb) + 1e-6
        if not near.all():
            out = np.full(len(a), np.nan, np.float32)
            some = np.flatnonzero(near)
            out[some] = edit_distances([a[k] for k in some], [b[k] for k in some])
            return out
    wb_row = np.concatenate((np.zeros((len(b), 1), np.float32), np.cumsum(wb, axis=1, dtype=np.float32)), axis=1)
    row = wb_row.copy()
    out = np.where(na == 0, row[np.arange(len(b)), nb], np.float32(0))
    c, g = (ord(x) for x in SPECIAL_REPLACE)
    for x in range(na.max() if len(na) else 0):
        char = ca[:, x : x + 1]
        swap = np.where(((char == c) & (cb == g)) | ((char == g) & (cb == c)), np.float32(SPECIAL_COST), np.float32(1))
        diagonal = row[:, :-1] + np.where(char == cb, np.float32(0), swap)
        new = np.empty_like(row)
        new[:, 0] = row[:, 0] + wa[:, x]
        new[:, 1:] = np.minimum(diagonal, row[:, 1:] + wa[:, x : x + 1])
        # Insertions run along the row: subtract the prefix costs, take the running minimum, add them again.
        new = np.minimum.accumulate(new - wb_row, axis=1) + wb_row
        row = new
        done = na == x + 1
        out[done] = row[done, nb[done]]
    return out


def _distance_batch(a: pd.Series, b: pd.Series, share: float | None = None) -> pd.Series:
    ok = np.array(a.notna() & b.notna())
    out = np.full(len(a), np.nan, np.float32)
    left, right = a[ok].tolist(), b[ok].tolist()
    at = np.flatnonzero(ok)
    # Pairs of like lengths are worked together, so that one long text doesn't widen all others.
    order = sorted(range(len(left)), key=lambda i: (len(left[i]), len(right[i])))
    start = 0
    while start < len(order):
        stop = start + 1
        cells = (len(left[order[start]]) + 1) * (len(right[order[start]]) + 1)
        while stop < len(order) and stop - start < 2048 and len(left[order[stop]]) <= len(left[order[start]]) + 4 and (stop - start) * cells < 1 << 21:
            stop += 1
        part = order[start:stop]
        out[at[part]] = edit_distances([left[i] for i in part], [right[i] for i in part], share)
        start = stop
    return pd.Series(out)


def edit_distance(a: Column, b: Column, share: float | None = None) -> Column:
    """Weighted edit distance as a float: free characters cost nothing, the dear one 5, C against G 2, all else 1. Null for null. With
    ``share`` also null where a bound shows that more than that share of the longer length is to be edited, which costs far less to see."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return _distance_batch(x, y, share)

    # Declared so that the optimizer doesn't run it anew for each use of its result (a filter and a column, say).
    d = F.pandas_udf(run, "float").asNondeterministic()(a, b)
    out = F.when(a.isNotNull() & b.isNotNull(), d)
    return out if share is None else F.nanvl(out, F.lit(None).cast("float"))


def edit_distance_expression(a: Column, b: Column) -> Column:
    """The same distance as one nested expression."""
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    cost = lambda x: F.when(F.lit(FREE).contains(x), F.lit(0.0)).when(x == DEAR, F.lit(DEAR_COST)).otherwise(F.lit(1.0))
    swap = lambda x, y: F.when(x == y, F.lit(0.0)).when(F.array_sort(F.array(x, y)) == F.array(*map(F.lit, SPECIAL_REPLACE)), F.lit(SPECIAL_COST)).otherwise(F.lit(1.0))
    first = F.aggregate(chars(b), F.array(F.lit(0.0)), lambda acc, y: F.concat(acc, F.array(F.element_at(acc, -1) + cost(y))))
    pairs = F.arrays_zip(chars(b).alias("y"), F.sequence(F.lit(1), F.greatest(F.length(b), F.lit(1))).alias("j"))

    def step(row: Column, x: Column) -> Column:
        start = F.array(F.get(row, F.lit(0)) + cost(x))

        def cell(acc: Column, p: Column) -> Column:
            y, j = p.getField("y"), p.getField("j")
            best = F.least(F.get(row, j - 1) + swap(x, y), F.get(row, j) + cost(x), F.element_at(acc, -1) + cost(y))
            return F.concat(acc, F.array(best))

        return F.aggregate(F.filter(pairs, lambda p: p.getField("y").isNotNull()), start, cell)

    return F.element_at(F.aggregate(chars(a), first, step), -1).cast("float")


def _longest(a: Column, b: Column) -> Column:
    return F.greatest(F.length(a), F.length(b))


def edit_sim(a: Column, b: Column, share: float | None = None) -> Column:
    """1 - distance / longer length in 32-bit floats, widened to double. Null for two empty texts (the rule's 0/0)."""
    ratio = (edit_distance(a, b, share) / _longest(a, b)).cast("float")
    return F.when(_longest(a, b) > 0, (F.lit(1).cast("float") - ratio).cast("float").cast("double"))


def edit_normalised(a: Column, b: Column) -> Column:
    return F.when(_longest(a, b) > 0, (edit_distance(a, b) / _longest(a, b)).cast("float"))


def length_factor(a: Column, b: Column) -> Column:
    """One half where a long text meets one of more than twice or less than half its length."""
    la, lb = F.length(a), F.length(b)
    return F.when((F.greatest(la, lb) >= LONG) & ((la > 2 * lb) | (2 * la < lb)), 0.5).otherwise(1.0)


def edit_similar(a: Column, b: Column, share: float | None = None) -> Column:
    return edit_sim(a, b, share) * length_factor(a, b)


def edit_similar_new(a: Column, b: Column) -> Column:
    """As edit_similar, but if the first word runs of both texts without blanks are equal, they count as one letter."""
    run = lambda c: F.regexp_extract(F.replace(c, F.lit(" "), F.lit("")), WORD_RUN, 0)
    same = (run(a) != "") & (run(a) == run(b))
    short = lambda c: F.when(same, F.replace(c, run(c), F.lit("a"))).otherwise(c)
    return edit_sim(short(a), short(b)) * length_factor(a, b)


def multiset_common(x: Column, y: Column) -> Column:
    """Size of the intersection of two arrays as multisets."""
    count = lambda arr, v: F.size(F.filter(arr, lambda e: e == v))
    return F.aggregate(F.array_intersect(x, y), F.lit(0), lambda acc, v: acc + F.least(count(x, v), count(y, v)))


def jaccard(x: Column, y: Column) -> Column:
    """Multiset overlap of two token arrays; null for two empty ones."""
    common = multiset_common(x, y)
    whole = F.size(x) + F.size(y) - common
    return F.when(whole > 0, common / whole)


def domain_jaccard(x: Column, y: Column, domain: list[str], weight: int = 3) -> Column:
    """Overlap of distinct tokens, where domain words weigh more."""
    words = F.array(*[F.lit(w) for w in domain]) if domain else F.array().cast("array<string>")
    total = lambda arr: F.aggregate(arr, F.lit(0), lambda acc, v: acc + F.when(F.array_contains(words, v), F.lit(weight)).otherwise(F.lit(1)))
    return F.when(F.size(F.array_union(x, y)) > 0, total(F.array_intersect(x, y)) / total(F.array_union(x, y)))


def combined(s1: Column, s2: Column) -> Column:
    """The larger of two similarities, or the smaller where it is below 0.1 and the larger below 0.75."""
    low, high = F.least(s1, s2), F.greatest(s1, s2)
    return F.when((low < 0.1) & (high < 0.75), low).otherwise(high)


def _no_blanks(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def similar_new(q1: Column, q2: Column, seg1: Column, seg2: Column, domain: list[str] | None = None) -> Column:
    """Combination of edit_similar_new on the texts without blanks and the tokens' overlap (weighted if domain words are given)."""
    overlap = jaccard(seg1, seg2) if domain is None else domain_jaccard(seg1, seg2, domain)
    return combined(edit_similar_new(_no_blanks(q1), _no_blanks(q2)), overlap)


def similar_old(q1: Column, q2: Column, seg1: Column, seg2: Column) -> Column:
    return F.greatest(edit_similar(_no_blanks(q1), _no_blanks(q2)), jaccard(seg1, seg2))


def cluster_distance(q1: Column, q2: Column, seg1: Column, seg2: Column) -> Column:
    return 1 - similar_old(q1, q2, seg1, seg2)


def model_number(c: Column) -> Column:
    """The first model number, 'none' without one: the equality key of the pair filter."""
    found = F.regexp_extract(c, MODEL, 0)
    return F.when(found == "", "none").otherwise(found)


def mixed_token(c: Column) -> Column:
    found = F.regexp_extract(_no_blanks(c), MIXED, 0)
    return F.when(found == "", "none").otherwise(found)


def adaptive_threshold(q1: Column, q2: Column, short: int = 5, high: float = 0.6) -> Column:
    """The similarity a pair must exceed: ``high`` for a short left text, 0.8 if one is more than twice the other, else 0.5."""
    la, lb = F.length(q1), F.length(q2)
    return F.when(la < short, F.lit(high)).when((2 * la < lb) | (la > 2 * lb), F.lit(0.8)).otherwise(F.lit(0.5))

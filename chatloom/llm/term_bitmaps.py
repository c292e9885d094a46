"""Problem 4: frequency of every distinct term, with a mark on the rare and the common.

Vertical layout: a compressed bitmap of record identifiers for each term beside an occurrence counter. Identifiers are split in containers
of 2^16 as in roaring bitmaps (sorted 16-bit arrays up to 4096 members, 8 KB bit sets beyond), built chunk by chunk on the workers, merged
by union for each (term, container), and the document frequency is the cardinality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import batches, materialize, table

#: Rows whose terms are counted at once in a task.
CHUNK_ROWS = 1 << 16
#: Members above which a container is a bit set.
ARRAY_MAX = 4096
SPACES = "[ \t　]+"
BITMAPS = "term string, container long, bits binary, n_occurrences long"


def members(bits: bytes) -> np.ndarray:
    """The 16-bit members of a container."""
    if len(bits) == 8192:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")).astype(np.uint16)
    return np.frombuffer(bits, np.uint16)


def packed(low: np.ndarray) -> bytes:
    """A container of sorted distinct members. An array of 4096 would have the length of a bit set, so bit sets start there."""
    if len(low) < ARRAY_MAX:
        return low.astype(np.uint16).tobytes()
    bits = np.zeros(65536, np.uint8)
    bits[low] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _vertical(split: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches(it, CHUNK_ROWS):
            t = t.combine_chunks()
            text = pc.utf8_trim(pc.replace_substring_regex(t.column("text").combine_chunks(), split, " "), " ")
            lists = pc.split_pattern(text, " ")
            terms, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
            keep = pc.not_equal(terms, "")
            terms, rows = terms.filter(keep), rows.filter(keep).to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(terms):
                continue
            coded = terms.dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            ids, place = np.unique(t.column("id").to_numpy().astype(np.int64), return_inverse=True)
            key, n = np.unique((code << 32) | place[rows], return_counts=True)
            # Beside the terms, under a null, the records that have any: their number comes out of the same pass.
            any_term = np.unique(key & 0xFFFFFFFF)
            key, n = np.concatenate((key, (len(coded.dictionary) << 32) | any_term)), np.concatenate((n, np.ones(len(any_term), n.dtype)))
            code, ids = key >> 32, ids[key & 0xFFFFFFFF]
            high, low = ids >> 16, (ids & 0xFFFF).astype(np.uint16)
            fresh = np.concatenate(([True], (code[1:] != code[:-1]) | (high[1:] != high[:-1])))
            start = np.flatnonzero(fresh)
            end = np.concatenate((start[1:], [len(code)]))
            occ = np.add.reduceat(n, start).astype(np.int64)
            small = (end - start) < ARRAY_MAX
            names = pa.concat_arrays([coded.dictionary, pa.array([None], coded.dictionary.type)])
            # Small containers are slices of one buffer: their bytes are laid out together without a loop.
            of_small = small[np.cumsum(fresh) - 1]
            offsets = np.concatenate(([0], np.cumsum((end - start)[small] * 2))).astype(np.int32)
            bits = pa.Array.from_buffers(pa.binary(), int(small.sum()), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low[of_small].tobytes())])
            for pick, data in ((small, bits), (~small, pa.array([packed(low[a:b]) for a, b in zip(start[~small], end[~small])], pa.binary()))):
                if pick.any():
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(code[start][pick])), pa.array(high[start][pick]), data, pa.array(occ[pick])], names=["term", "container", "bits", "n_occurrences"])

    return run


def _union(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union of the containers of each (term, container); the stream is ordered by both, and a run may cross batches."""
    held: tuple | None = None

    def done(h: tuple) -> tuple:
        term, container, parts, n = h
        if len(parts) == 1:
            return term, container, parts[0], n
        return term, container, packed(np.unique(np.concatenate([members(p) for p in parts]))), n

    for b in it:
        if not b.num_rows:
            continue
        terms, containers, bits, occ = (b.column(i).to_pylist() for i in range(4))
        out = []
        for term, container, x, n in zip(terms, containers, bits, occ):
            if held is not None and held[0] == term and held[1] == container:
                held = (term, container, [*held[2], x], held[3] + n)
                if len(held[2]) >= 64:  # a long run is folded as it comes
                    t, c, y, m = done(held)
                    held = (t, c, [y], m)
            else:
                if held is not None:
                    out.append(done(held))
                held = (term, container, [x], n)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.binary(), pa.int64()))], names=["term", "container", "bits", "n_occurrences"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(done(held), (pa.string(), pa.int64(), pa.binary(), pa.int64()))], names=["term", "container", "bits", "n_occurrences"])


def term_bitmaps(df: DataFrame, text: str, record_id: str | None = None, split: str = SPACES) -> DataFrame:
    """The vertical index: term, container (identifier >> 16), bits (its members' lower 16 bits), n_occurrences there.

    ``record_id`` is a bigint column without nulls; rows that share an identifier are one record. Without it every row is a record of its
    own. Terms are the non-empty pieces of ``text`` between runs of ``split``; null and blank texts have none."""
    return _index(df, text, record_id, split).where("term is not null")


def _index(df: DataFrame, text: str, record_id: str | None, split: str) -> DataFrame:
    """term_bitmaps, with the bitmap of all records that have a term under a null term."""
    ids = F.col(record_id).cast("long") if record_id else F.monotonically_increasing_id()
    rows = df.select(ids.alias("id"), F.col(text).alias("text")).where("text is not null")
    parts = rows.mapInArrow(_vertical(split), BITMAPS)
    return parts.repartition("term", "container").sortWithinPartitions("term", "container").mapInArrow(_union, BITMAPS)


def term_frequencies(df: DataFrame, text: str, record_id: str | None = None, rare_max: int = 2, common_parts: int = 10, split: str = SPACES) -> DataFrame:
    """term, n_occurrences, n_rows (document frequency), mark.

    ``mark`` is 'rare' up to ``rare_max`` rows, 'common' in more than one in ``common_parts`` of the rows that have a term, else null;
    rare wins where both hold. Repeated rows all count; a term counts once per row in n_rows. Other columns don't matter. An empty table
    or one of blank texts gives no rows."""
    size = F.when(F.length("bits") == 8192, F.lit(None)).otherwise(F.expr("length(bits) div 2"))
    large = F.expr("length(bits) = 8192")
    bits = _index(df, text, record_id, split)
    counted = bits.select("term", "n_occurrences", F.when(large, F.expr("bitmap_count(bits)")).otherwise(size).cast("long").alias("n"))
    terms = materialize(counted.groupBy("term").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n").alias("n_rows")), "p4-terms")
    total = terms.where("term is null").agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    mark = F.when(F.col("n_rows") <= rare_max, "rare").when(F.col("n_rows") * common_parts > F.lit(total), "common")
    return terms.where("term is not null").select("term", "n_occurrences", "n_rows", mark.alias("mark"))


def p4_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_frequencies(table(spark, sf_dir, "robot_log"), "segment")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_frequencies(table(spark, sf_dir, "robot_log"), "segment").where("mark is not null").select("term", "mark")


_TERMS = r"""
  t as (select log_id, unnest(string_split_regex(segment, '[ \t\x{3000}]+')) as term from robot_log where segment is not null),
  k as (select term, count(*) as n_occurrences, count(distinct log_id) as n_rows from t where term <> '' group by term),
  n as (select count(distinct log_id) as n from t where term <> ''),
  m as (select term, n_occurrences, n_rows, case when n_rows <= 2 then 'rare' when n_rows * 10 > n then 'common' end as mark from k, n)
"""
SQL = {"p4_terms": f"with {_TERMS} select * from m", "p4_found": f"with {_TERMS} select term, mark from m where mark is not null"}
QUERIES = {"p4_terms": p4_terms, "p4_found": p4_found}

"""Problem 8: encoding of the whole corpus with a public byte-level BPE vocabulary.

Tree concatenation: a long text is cut in blocks that are encoded in parallel by different tasks; a long run that the word pattern leaves
unsplit is cut likewise, and within a task halved down to short pieces. The encodings of the parts of one run are joined pairwise, rounds of
neighbours after one another: at each join a window of tokens is encoded again and grown until its outermost tokens on both sides come out
as they were.

Why that is exact: byte-level BPE takes a sequence of tokens as the encoding of its bytes if and only if each two neighbours, put together,
encode to just those two. Inside the two halves that holds; inside the window too; and where the window's outermost tokens are the old ones,
the pairs across its rims are old pairs.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.runtime import table

TOKENIZER = os.environ.get("CHATLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The word pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text above which its blocks are encoded by different tasks.
BLOCK_CHARS = 1 << 18
#: Characters of one unsplit piece above which it is halved.
PIECE_CHARS = 1 << 10
#: Tokens on each side of a join that are encoded again at first.
WINDOW = 4


@functools.lru_cache(maxsize=2)
def encoder(ranks: bytes):
    """The encoder of a rank file's bytes, once per worker process."""
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def _piece(enc, data: bytes) -> list[int]:
    """The tokens of bytes taken as one piece."""
    return enc._encode_single_piece(data) if data else []


def join_encodings(enc, left: list[int], right: list[int]) -> list[int]:
    """The encoding of two adjoining parts of one piece, from the parts' encodings."""
    if not left or not right:
        return left + right
    k = WINDOW
    while True:
        a, b = left[-k:], right[:k]
        new = _piece(enc, enc.decode_bytes(a + b))
        whole_left, whole_right = len(a) == len(left), len(b) == len(right)
        if (whole_left or new[0] == a[0]) and (whole_right or new[-1] == b[-1]) and (len(new) > 1 or whole_left and whole_right):
            return left[: len(left) - len(a)] + new + right[len(b) :]
        k *= 2


def encode_piece(enc, text: str) -> list[int]:
    """A long unsplit piece by halves."""
    if len(text) <= PIECE_CHARS:
        return _piece(enc, text.encode())
    half = len(text) // 2
    return join_encodings(enc, encode_piece(enc, text[:half]), encode_piece(enc, text[half:]))


@functools.cache
def _long_run():
    import regex

    n = PIECE_CHARS
    return regex.compile(rf"\p{{L}}{{{n},}}|\p{{N}}{{{n},}}|[^\s\p{{L}}\p{{N}}]{{{n},}}|\s{{{n},}}")


@functools.cache
def _words():
    import regex

    return regex.compile(PATTERN)


def has_long_run(text: str) -> bool:
    return len(text) >= PIECE_CHARS and _long_run().search(text) is not None


def encode_text(enc, text: str) -> list[int]:
    """A text's ids. Only texts with a long unsplit run leave the library's own path."""
    if not has_long_run(text):
        return enc.encode_ordinary(text)
    out: list[int] = []
    for m in _words().finditer(text):
        out += encode_piece(enc, m.group())
    return out


def _class(c: str) -> str:
    """L, N or O of a character on whose class all Unicode versions agree, else ''."""
    if "a" <= c.lower() <= "z" and c.isascii() or "\u4e00" <= c <= "\u9fa5":
        return "L"
    if "0" <= c <= "9":
        return "N"
    return "O" if " " <= c <= "~" or c in "\t\n\r\u3000\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f" else ""


def _safe(text: str, at: int) -> bool:
    """Whether the word pattern certainly splits before position ``at``: a letter or number stands before it and another class after
    it. No word of the pattern holds such a pair."""
    a, b = _class(text[at - 1]), _class(text[at])
    return a in ("L", "N") and b not in ("", a)


#: What a block is: a text of its own, the end of a run that the blocks before it began, or a part of a run that goes on.
WHOLE, LAST, GOES_ON = 0, 1, 2


def blocks(text: str, size: int) -> list[tuple[str, int]]:
    """Cut a long text in blocks of about ``size`` characters, each with its kind. Cuts are at certain word borders; where there is none for
    another ``size`` characters, the stretch between the two certain borders around is split by the word pattern, and a word of it that is
    longer than ``size`` is cut in parts of that length."""
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and at < start + 2 * size and not _safe(text, at):
            at += 1
        if at < len(text) and _safe(text, at):
            out.append((text[start:at], WHOLE))
            start = at
            continue
        low = start + size
        while low > start and not _safe(text, low):
            low -= 1
        while at < len(text) and not _safe(text, at):
            at += 1
        if low > start:
            out.append((text[start:low], WHOLE))
        out += _stretch(text[low:at], size)
        start = at
    if start < len(text):
        out.append((text[start:], WHOLE))
    return out


def _stretch(text: str, size: int) -> list[tuple[str, int]]:
    """Blocks of a stretch between certain borders: words beyond ``size`` in parts, the short words between them in texts of about ``size``.

    What a text holds is split as in the whole, for the pattern looks ahead only behind white space: white space that would end a text
    is left out of it and stands as words of its own."""
    out: list[tuple[str, int]] = []
    held: list[tuple[int, int]] = []

    def flush() -> None:
        last = len(held)
        while last and text[held[last - 1][0] : held[last - 1][1]].isspace():
            last -= 1
        if last:
            out.append((text[held[0][0] : held[last - 1][1]], WHOLE))
        out.extend((text[x:y], LAST) for x, y in held[last:])
        held.clear()

    for a, b in (m.span() for m in _words().finditer(text)):
        if b - a > size:
            flush()
            cuts = [*range(a, b, size), b]
            out += [(text[x:y], LAST if y == b else GOES_ON) for x, y in zip(cuts, cuts[1:])]
        else:
            held.append((a, b))
            if b - held[0][0] >= size:
                flush()
    flush()
    return out


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32, copy=False) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _ids(enc, text: str, kind: int) -> np.ndarray:
    """One text's ids as an array, so that no batch is held as Python numbers."""
    if kind != WHOLE:
        return np.array(encode_piece(enc, text), np.int32)
    if has_long_run(text):
        return np.array(encode_text(enc, text), np.int32)
    return enc.encode_to_numpy(text, disallowed_special=()).view(np.int32)


def _encode(ranks: bytes):
    """Ids in place of the last column, the text; of a part of a run, told by column ``kind``, the ids of the part alone."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        for b in it:
            texts = b.column("text").to_pylist()
            kinds = b.column("kind").to_pylist() if "kind" in b.schema.names else [WHOLE] * len(texts)
            ids = [_ids(enc, t, kind) if t else np.empty(0, np.int32) for t, kind in zip(texts, kinds)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), _lists(ids)], names=[*b.schema.names[:-1], "ids"])

    return run


def join_parts(enc, parts: list[list[int]]) -> list[int]:
    """The encoding of a run from its parts', joined in rounds of neighbours."""
    while len(parts) > 1:
        parts = [join_encodings(enc, *parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _assemble(ranks: bytes):
    """The ids of each text from its blocks', which come in order."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        row, key, done, run_parts = None, None, [], []

        def text() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([key, _lists([np.concatenate(done)])], names=["key", "ids"])

        for b in it:
            rows, kinds = b.column("row").to_pylist(), b.column("kind").to_pylist()
            for k in range(b.num_rows):
                if rows[k] != row:
                    if row is not None:
                        yield text()
                    row, key, done, run_parts = rows[k], b.column("key").slice(k, 1), [], []
                ids = b.column("ids")[k].values.to_numpy(zero_copy_only=False)
                if kinds[k] == WHOLE:
                    done.append(ids)
                else:
                    run_parts.append(ids.tolist())
                    if kinds[k] == LAST:
                        done.append(np.array(join_parts(enc, run_parts), np.int32))
                        run_parts = []
        if row is not None:
            yield text()

    return run


def _cut(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"text": x, "kind": kind} for x, kind in blocks(t, BLOCK_CHARS)])


def long_texts(rows: DataFrame, ranks: bytes) -> DataFrame:
    """key and ids of texts beyond ``BLOCK_CHARS``: their blocks, also those of one unsplit run, are encoded by different tasks."""
    spark, kind = rows.sparkSession, rows.schema["key"].dataType.simpleString()
    made = F.pandas_udf(_cut, "array<struct<text:string,kind:int>>")("text")
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # before the texts are taken apart: one number for all blocks
    cut = numbered.select("key", "row", made.alias("bs")).select("key", "row", F.posexplode("bs").alias("block", "b")).select("key", "row", "block", "b.kind", "b.text")
    # Few bytes and much work in each row: as many tasks as the session has, whatever the bytes.
    spread = cut.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row", "block")
    parts = spread.mapInArrow(_encode(ranks), f"key {kind}, row long, block int, kind int, ids array<int>")
    return parts.repartition("row").sortWithinPartitions("row", "block").mapInArrow(_assemble(ranks), f"key {kind}, ids array<int>")


def token_ids(df: DataFrame, key: str, text: str, tokenizer: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every row, in the ids of the rank file ``tokenizer``, without special tokens.

    Null and empty texts give an empty list; strings that look like special tokens are ordinary text; texts are encoded whole. Rows with
    equal or null keys each give a row. Texts beyond ``BLOCK_CHARS`` are cut, encoded block by block in different tasks and put together
    again in order. Other columns of ``df`` are ignored. An empty table stays empty. The rank file is read where the session runs and
    travels to the workers (under 1 MB for a vocabulary of 50,000). Long texts come from a second scan, as the short ones take no exchange."""
    with open(tokenizer or TOKENIZER, "rb") as f:
        ranks = f.read()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    long = F.coalesce(F.length("text") > BLOCK_CHARS, F.lit(False))
    short = rows.where(~long).mapInArrow(_encode(ranks), f"key {kind}, ids array<int>")
    return short.unionByName(long_texts(rows.where(long), ranks)).withColumnRenamed("key", key)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"), "doc_id", "text")


SQL: dict[str, str] = {}
QUERIES = {"p8_ids": p8_ids}

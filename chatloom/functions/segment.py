"""Segmentation of questions. No dictionary is built in: modes by expression, a forward maximum match over given words with or without
their parts of speech (natures), and a plug-in for a real segmenter. The tokens of another segmenter's dictionary are not reproduced."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HAN = "一-龥"
#: Words up to which a dictionary is one regular expression on the JVM.
ALTERNATIVES = 256
RUN = rf"[{HAN}]|[a-zA-Z0-9]+"


def tokenize(c: Column, mode: str = "char") -> Column:
    """'whitespace': pieces between blanks; 'char': Han characters and runs of letters and digits; 'cjk_bigram': pairs of neighbouring Han
    characters (a lone one alone) and runs. Null gives null, a text without tokens an empty array."""
    if mode == "whitespace":
        return F.filter(F.split(c, r"\s+"), lambda t: t != "")
    if mode == "char":
        return F.regexp_extract_all(c, F.lit(f"({RUN})"), F.lit(1))
    if mode == "cjk_bigram":
        runs = F.regexp_extract_all(c, F.lit(rf"([{HAN}]+|[a-zA-Z0-9]+)"), F.lit(1))
        grams = lambda r: F.when(r.rlike(f"^[{HAN}]{{2,}}"), F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array(r))
        return F.flatten(F.transform(runs, grams))
    raise ValueError(f"no mode {mode}")


def maximum_match(text: str, words: frozenset[str], longest: int) -> list[str]:
    out, at = [], 0
    while at < len(text):
        n = next((k for k in range(min(longest, len(text) - at), 1, -1) if text[at : at + k] in words), 1)
        if not text[at : at + n].isspace():
            out.append(text[at : at + n])
        at += n
    return out


def _by_words(c: Column, words: list[str]) -> Column:
    """Forward maximum match: one alternation over a short list of words, longest first, else a match by sets of words."""
    held = frozenset(w for w in words if len(w) > 1)
    if len(held) <= ALTERNATIVES:
        each = [*sorted(map(re.escape, held), key=lambda w: (-len(w), w)), r"\S"]
        return F.regexp_extract_all(c, F.lit(f"(?U)({'|'.join(each)})"), F.lit(1))
    longest = max(map(len, held))
    return F.pandas_udf(lambda texts: texts.map(lambda t: None if t is None else maximum_match(t, held, longest)), "array<string>")(c)


def dictionary_tokens(c: Column, words: list[str], stop_words: list[str] | None = None) -> Column:
    """Forward maximum match over the words, without stop words; characters of no word stand alone, white space is left out."""
    tokens = _by_words(c, words)
    return F.filter(tokens, lambda t: ~t.isin(stop_words)) if stop_words else tokens


def dictionary_terms(c: Column, natures: dict[str, str], other: str = "") -> Column:
    """dictionary_tokens with the nature (part of speech) of each word: array of (word, nature). ``other`` is that of single characters."""
    known = F.create_map(*[F.lit(x) for pair in sorted(natures.items()) for x in pair]) if natures else None
    nature = lambda w: F.coalesce(F.try_element_at(known, w), F.lit(other)) if known is not None else F.lit(other)
    return F.transform(_by_words(c, list(natures)), lambda w: F.struct(w.alias("word"), nature(w).alias("nature")))


def plugged_tokens(c: Column, segmenter: Callable[[], Callable[[str], list[str]]]) -> Column:
    """Tokens of a segmenter that ``segmenter`` makes once per worker."""
    return _plugged(c, segmenter, "array<string>", lambda out: out)


def plugged_terms(c: Column, segmenter: Callable[[], Callable[[str], list[tuple[str, str]]]]) -> Column:
    """Terms (word, nature) of a segmenter that ``segmenter`` makes once per worker: the contract for accurate, dictionary-first and
    context-aware segmenters with parts of speech."""
    return _plugged(c, segmenter, "array<struct<word:string,nature:string>>", lambda out: [{"word": w, "nature": n} for w, n in out])


def _plugged(c: Column, segmenter: Callable, kind: str, shape: Callable) -> Column:
    made: list = []

    def run(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(segmenter())
        return texts.map(lambda t: None if t is None else shape(made[0](t)))

    return F.pandas_udf(run, kind)(c)


def without(terms: Column, stop_words: list[str] | None = None, stop_natures: list[str] | None = None) -> Column:
    """Terms that are no stop word and of no stop nature."""
    return F.filter(terms, lambda t: ~(t["word"].isin(stop_words or []) | F.coalesce(t["nature"].isin(stop_natures or []), F.lit(False))))


def words_of(terms: Column) -> Column:
    return F.transform(terms, lambda t: t["word"])


def with_natures(terms: Column, word_sep: str = " ", nature_sep: str = "/") -> Column:
    """Terms as text: word, separator, nature; a missing nature is empty."""
    return F.array_join(F.transform(terms, lambda t: F.concat(t["word"], F.lit(nature_sep), F.coalesce(t["nature"], F.lit("")))), word_sep)


def drop_first(tokens: Column, stop_words: list[str]) -> Column:
    """Tokens without the first occurrence of each stop word (a word listed twice goes twice); later ones stay."""
    if not stop_words:
        return tokens

    def less(left: Column, w: Column) -> Column:
        at = F.array_position(left, w).cast("int")
        return F.when(at > 0, F.concat(F.slice(left, F.lit(1), at - 1), F.slice(left, at + 1, F.size(left)))).otherwise(left)

    return F.aggregate(F.array(*map(F.lit, stop_words)), tokens, less)


def only_chinese(tokens: Column) -> Column:
    """Tokens that hold a Han character."""
    return F.filter(tokens, lambda t: t.rlike(f"[{HAN}]"))

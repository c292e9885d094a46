"""Problem 3: visually identical text with different characters.

DuckDB runs inside the Arrow partitions: embedded SQL of translate, replace, regular expressions and nfc_normalize brings every text
to one form. The character tables come from Unicode rules, but for the short list of look-alike letters.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.runtime import batches, broadcast_if_small, table

# Letters of other scripts with the shape of a Latin letter, each before its Latin twin. Left out are letters that differ in
# shape in most fonts, such as the small Greek ones but omicron.
LOOK_ALIKES = (
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ԚQ ԜW ҮY ӀI аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl ғf "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo ϳj ͿJ ՕO օo ՏS ոn ѵv ѴV ԌG "
    # Cherokee, Lisu and Coptic letters.
    "ᎪA ᏴB ᏟC ᎠD ᎬE ᏀG ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᎳW ᏃZ "
    "ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU "
    "ⲀA ⲂB ⲈE ⲎH ⲒI ⲔK ⲘM ⲚN ⲞO ⲢP ⲤC ⲦT ⲨY ⲬX ⲟo ⲣp ⲥc"
)
#: Code points searched for compatibility forms; none lies beyond.
LAST = 0x30000
#: Rows taken to DuckDB at once.
BATCH_ROWS = 1 << 16


def _invisible(c: str) -> bool:
    """Characters without ink that take no room: format and control characters, variation selectors, joiners and fillers."""
    o, kind = ord(c), unicodedata.category(c)
    if c.isspace():
        return False
    return kind in ("Cf", "Cc") or o in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= o <= 0xFE0F or 0x180B <= o <= 0x180F or 0xE0000 <= o <= 0xE0FFF


def _blank(c: str) -> bool:
    return c.isspace() or unicodedata.category(c) in ("Zs", "Zl", "Zp") or c == "⠀"


@functools.cache
def one_form_table() -> dict[str, str]:
    """Every character that changes, with its one form ('' for characters without ink). Combining accents are composed later."""
    twin = {x[0]: x[1] for x in LOOK_ALIKES.split()}
    out = {}
    for o in [*range(0x80), *range(0x80, LAST), *range(0xE0000, 0xE1000)]:
        c = chr(o)
        if 0xD800 <= o < 0xE000 or 0x3400 <= o < 0xA000 or 0xAC00 <= o < 0xD7A4:
            continue
        parts = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", c))
        new = unicodedata.normalize("NFC", "".join(" " if _blank(x) else "" if _invisible(x) else twin.get(x, x) for x in parts))
        if _blank(c):
            new = " "
        elif _invisible(c):
            new = ""
        if new != unicodedata.normalize("NFC", c):
            out[c] = new
    return out


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _expression(odd: set[str], forms: dict[str, str], column: str) -> str:
    """The SQL expression for texts that hold no other characters of the table than ``odd``."""
    present = sorted(c for c in odd if c in forms)
    single = [c for c in present if len(forms[c]) == 1]
    gone = [c for c in present if not forms[c]]
    sql = column
    if gone:
        sql = f"regexp_replace({sql}, {_quoted('[' + ''.join(f'\\x{{{ord(c):x}}}' for c in gone) + ']+')}, '', 'g')"
    for c in present:
        if len(forms[c]) > 1:
            sql = f"replace({sql}, {_quoted(c)}, {_quoted(forms[c])})"
    if single:
        sql = f"translate({sql}, {_quoted(''.join(single))}, {_quoted(''.join(forms[c] for c in single))})"
    return f"nfc_normalize({sql})"


def _normalizer(text: str, out: str):
    forms = one_form_table()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})  # nothing goes to a local disk
        for t in batches(it, BATCH_ROWS):
            texts = t.column(text).combine_chunks() if t.num_rows else t.column(text)
            codes = texts.dictionary_encode() if not isinstance(texts, pa.ChunkedArray) else texts.combine_chunks().dictionary_encode()
            x = pa.table({"i": pa.array(range(len(codes.dictionary)), pa.int32()), "q": codes.dictionary})  # noqa: F841  read by the SQL below
            con.register("x", x)
            # NUL can't be written into a regular expression's text or a SQL literal; it is removed by its own call.
            odd = {r[0] for r in con.execute(r"select distinct unnest(string_split(regexp_replace(q, '[ -~\x{3400}-\x{9fff}\x{ac00}-\x{d7a3}]+', '', 'g'), '')) from x").fetchall()}
            sql = _expression(odd - {"\0"}, forms, "replace(q, chr(0), '')" if "\0" in odd else "q")
            new = con.sql(f"select {sql} as q from x order by i").to_arrow_table().column("q").combine_chunks().cast(pa.string())
            con.unregister("x")
            columns = {n: t.column(n) for n in t.column_names if n != out}
            columns[out] = new.take(codes.indices)
            for b in pa.table(columns).to_batches():
                yield b

    return run


def one_form(df: DataFrame, text: str, out: str = "one_form") -> DataFrame:
    """``df`` with the one form of column ``text`` in column ``out`` (replaced if it exists); all other columns stay.

    Two texts get the same form if they differ only in Unicode compatibility forms, accents joined or apart, characters without ink, the
    kind of a blank (one for one, tabs and line ends included) or letters of another script of the same shape. Capitals, accents, digits and
    the number of blanks are kept. Null gives null, the empty text and one of ink-less characters only give the empty text. Texts of any
    length are worked whole. An empty table stays empty."""
    fields = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.StringType())])
    return df.select(*[F.col(f"`{f.name}`") for f in fields]).mapInArrow(_normalizer(text, out), schema)


def read_the_same(rows: DataFrame, text: str, standard: DataFrame, standard_text: str) -> DataFrame:
    """Rows joined with the standard texts that read the same without being the same string.

    ``rows`` and ``standard`` keep their columns, which must have different names. Null texts match nothing. Rows of one hot text need no
    shuffle while the standard side is counted to be small; beyond that AQE splits skewed partitions."""
    n = standard.count()
    forms = one_form(standard, standard_text, "_standard_form").where("_standard_form is not null")
    found = one_form(rows.where(F.col(text).isNotNull()), text, "_form")
    joined = found.join(broadcast_if_small(forms, n, 1024), F.col("_form") == F.col("_standard_form"))
    return joined.where(F.col(text) != F.col(standard_text)).drop("_form", "_standard_form")


def p3_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question's one form."""
    return one_form(table(spark, sf_dir, "robot_log").select("log_id", "question"), "question", "form")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "robot_log").select("log_id", "question")
    standard = table(spark, sf_dir, "std_question").select("std_id", F.col("question").alias("standard"))
    return read_the_same(rows, "question", standard, "standard").select("log_id", "std_id").distinct()


SQL: dict[str, str] = {}
QUERIES = {"p3_forms": p3_forms, "p3_found": p3_found}

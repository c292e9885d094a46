"""Other string, number and date functions as column expressions. Null stays null unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of these functions.
DECIMAL = r"[0-9]+(.[0-9]*)?|.{1}[0-9]+"
SENTENCE_CLASS = r"[^0-9a-zA-Z\\pP]"
UNPARSED = "1970-01-01"
NOW = "auto"
TIME = "yyyy-MM-dd HH:mm:ss"


def esc(c: Column) -> Column:
    """Backslashes and double quotes escaped."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def remove_char(c: Column, also: str = "") -> Column:
    """Runs of punctuation and of the characters ``also`` become one blank, if anything else is there (line ends that
    stand apart from one another keep the pattern from matching, and the text stays)."""
    other = c.rlike(rf"\A.*[^\p{{P}}{also}]+.*\z")
    return F.when(other, F.trim(F.regexp_replace(c, rf"[\p{{P}}{also}]+", " "))).otherwise(c)


def is_illegal_char(c: Column, also: str = "") -> Column:
    return ~c.rlike(rf"\A.*[^\p{{P}}{also}]+.*\z")


def contain_chinese_line(c: Column) -> Column:
    """Unlike contains_chinese, false for a text with line ends."""
    return c.rlike(r"\A.*[一-龥].*\z")


def remove_brackets(c: Column) -> Column:
    """One leading '(' and one trailing ')'."""
    return F.regexp_replace(F.regexp_replace(c, r"\A\(", ""), r"\)\z", "")


def remove_quotations(c: Column) -> Column:
    """The quotes of both ends, or else of one; texts with line ends stay."""
    both, last, first = (rf"\A{x}\z" for x in ('"(.*)"', '(.*)"', '"(.*)'))
    return F.when(c.rlike(both), F.regexp_extract(c, both, 1)).when(c.rlike(last), F.regexp_extract(c, last, 1)).when(c.rlike(first), F.regexp_extract(c, first, 1)).otherwise(c)


def replace_quotations(c: Column) -> Column:
    both = r'\A"(.*)"\z'
    return F.when(c.rlike(both), F.regexp_extract(c, both, 1)).otherwise(c)


def is_decimal(c: Column, mode: str = "reference") -> Column:
    """'reference': the dot of the pattern stands for any character, so 'a5' counts; 'strict': it is a dot."""
    return c.rlike(rf"\A(?:{DECIMAL})\z") if mode == "reference" else c.rlike(r"\A(?:[0-9]+(\.[0-9]*)?|\.[0-9]+)\z")


def tuple_to_string(columns: list[Column], sep: str) -> Column:
    """All columns joined; null is written as the word null, as in the string form of a tuple."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])


def is_contain_english(c: Column) -> Column:
    return c.rlike(r"\A.*[a-zA-Z]{2,}.*\z")


def is_contain_number(c: Column) -> Column:
    return c.rlike(r"\A.*[0-9]+.*\z")


def is_english_sentence(c: Column) -> Column:
    """True if all characters are ASCII letters and digits, a backslash, p or P: blanks are not in the class."""
    return ~c.rlike(SENTENCE_CLASS)


def uuid() -> Column:
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def date_reformat(c: Column, source: str, target: str) -> Column:
    return F.date_format(F.try_to_timestamp(c, F.lit(source)), target)


def get_date(c: Column, pattern: str = TIME) -> Column:
    """The date, 1970-01-01 where the text can't be parsed (null included); ``auto`` stands for now."""
    return F.coalesce(F.date_format(_moment(c, pattern), "yyyy-MM-dd"), F.lit(UNPARSED))


def get_time(c: Column, pattern: str = TIME) -> Column:
    return F.coalesce(F.date_format(_moment(c, pattern), TIME), F.lit(UNPARSED))


def _moment(c: Column, pattern: str) -> Column:
    return F.when(c == NOW, F.current_timestamp()).otherwise(F.try_to_timestamp(c, F.lit(pattern)))


def _millis(c: Column, pattern: str) -> Column:
    return F.unix_millis(F.try_to_timestamp(c, F.lit(pattern)))


def diff_millis(begin: Column, end: Column, pattern: str = TIME) -> Column:
    """End minus begin; 0 where either can't be parsed."""
    return F.coalesce(_millis(end, pattern) - _millis(begin, pattern), F.lit(0).cast("long"))


def diff_days(begin: Column, end: Column, pattern: str = TIME) -> Column:
    return F.floor(F.abs(diff_millis(begin, end, pattern)) / 86400000)


def age_from_birth(c: Column, year: int) -> Column:
    """Years up to ``year``; the empty text for null, short or unparsable births."""
    return F.when(F.length(c) >= 6, F.coalesce((F.lit(year) - F.substring(c, 1, 4).try_cast("int")).cast("string"), F.lit(""))).otherwise("")


def timestamp_millis(c: Column) -> Column:
    return _millis(c, TIME)


def time_before(c: Column, days: int) -> Column:
    return F.date_format(F.try_to_timestamp(c, F.lit(TIME)) - F.expr(f"interval {days} days"), TIME)


def truncated(c: Column, n: int = 100, tail: str = "......") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(tail))).otherwise(c)


def value_mock(c: Column, factor: float, seed: int) -> Column:
    """Scaling with a seeded random part: v * f + floor(random * f)."""
    return c * F.lit(factor) + F.floor(F.rand(seed) * factor)


def java_split(c: Column, pattern: str) -> Column:
    """Split without trailing empty fields; the empty text gives one empty field."""
    parts = F.split(c, pattern)
    last = F.aggregate(F.sequence(F.lit(1), F.size(parts)), F.lit(0), lambda acc, i: F.when(F.get(parts, i - 1) != "", i).otherwise(acc))
    return F.when(c == "", F.array(F.lit(""))).otherwise(F.slice(parts, 1, last))

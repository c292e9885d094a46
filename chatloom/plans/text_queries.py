"""One query per text function, over all questions of the log, with its DuckDB equivalent.

The questions are put between marks of the kinds the functions look for (by log_id, so that both engines build the same texts)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import clean, strings
from chatloom.runtime import table

VARIANTS = [
    ("", ""), ("声音=", "x.amr尾"), ("[CQ:at,qq=123456]", "@1234567]"), ("&#91;大笑&#93;", "[CQ:face,id=12]"), ("图片http", "0123456789ab"), ("[Image:{ABCDEF0123456}.gif]", "。。"),
    ("请您一次只问一个问题，而且尽量简短哟！", "face12.gif"), ("[ABCDEF 0123]", "（是）"), ("(@12345)", "\r\n"), ("\"", "\""), ("(", ")"), ("[{a}]", "[@b]"), ("12.5", "https://a.example.com/x?y"),
    ("哈哈哈哈", "！！"), ("abababab", "。"), ("@昵称(123456)", "原创表情abcdef12345"), ("３全角", "  两  格 "),
]
# Whole texts for the functions that look at a text in full.
WHOLE = ["a5", "12", "1.5", ".5", "x", "你好", "亲在吗", "aaaa", "ababab", "我知道了", "(a)", "hello world", "helloWorld1", "，。", "尼玛的", "哈哈哈哈", "1985-03-04", "1985", "2023-05-01 10:00:00", "2023-13-01 10:00:00", "\"引\"", ""]


def _text() -> Column:
    x = None
    for i, (a, b) in enumerate(VARIANTS):
        here = F.concat(F.lit(a), F.col("question"), F.lit(b))
        cond = F.pmod("log_id", F.lit(2 * len(VARIANTS))) == i
        x = F.when(cond, here) if x is None else x.when(cond, here)
    for i, w in enumerate(WHOLE):
        x = x.when((F.pmod("log_id", F.lit(2 * len(VARIANTS))) >= len(VARIANTS)) & (F.pmod(F.floor(F.col("log_id") / 64), F.lit(2 * len(WHOLE))) == i), F.lit(w))
    return x.otherwise(F.col("question"))


def _quote(s: str) -> str:
    return "concat(" + ", ".join("chr(10)" if c == "\n" else "chr(13)" if c == "\r" else "'" + c.replace("'", "''") + "'" for c in (s if any(k in s for k in "\r\n") else [s])) + ")"


def _duck_text() -> str:
    n = len(VARIANTS)
    arms = [f"when log_id % {2 * n} = {i} then {_quote(a)} || question || {_quote(b)}" for i, (a, b) in enumerate(VARIANTS)]
    arms += [f"when log_id % {2 * n} >= {n} and (log_id // 64) % {2 * len(WHOLE)} = {i} then {_quote(w)}" for i, w in enumerate(WHOLE)]
    return f"(select log_id, case {' '.join(arms)} else question end as x from robot_log)"


def _re(p: str) -> str:
    """A pattern as a DuckDB literal."""
    return "'" + p.replace("'", "''") + "'"


def _drop(p: str, x: str = "x", by: str = "''") -> str:
    return f"regexp_replace({x}, {_re(p)}, {by}, 'g')"


def _chain(rules: list[str], x: str = "x") -> str:
    for r in rules:
        x = _drop(r, x)
    return x


_MARKS, _WORD, _HAN = clean.CHINESE_MARKS, clean.WORD, clean.HAN
_FACES = "|".join(clean.FACES)
_PICTURES = "|".join(clean.PICTURES)


def basic_sql(x: str) -> str:
    return _drop(r"[\r\n]", _drop(clean.HEX, _drop(_FACES, _drop("|".join(clean.QQ_MARKS), _drop(_PICTURES, _drop(clean.VOICE, x))))))


def simplify_sql(x: str) -> str:
    cleaned = basic_sql(_drop("|".join(clean.MEANINGLESS), x))
    return f"lower(trim({_drop(r'\s{2,}', _drop(f'[{_MARKS}]', cleaned, "' '"), "' '")}))"


def ignore_sql(x: str) -> str:
    cleaned = _drop(f"[^{_WORD}]+$", _drop(f"^[^{_WORD}]+", basic_sql(x)))
    return f"lower(trim({_drop(f'[^{_HAN}A-Za-z0-9{clean.KEPT_SYMBOLS}]', cleaned)}))"


def repeats_sql(x: str, n: int) -> str:
    """True if some letter or Han character stands n times in a row (DuckDB's expressions know no back-references)."""
    return f"len(list_filter(range(1, length({x}) - {n} + 2), lambda i: substr({x}, i, {n}) = repeat(substr({x}, i, 1), {n}) and regexp_full_match(substr({x}, i, 1), '[{_HAN}a-zA-Z]'))) > 0"


def check_sql(x: str, ex: str, low: int, high: int, n: int = 4) -> str:
    return (
        f"coalesce(({ex} is null or lower({ex}) = 'null' or trim({ex}) = '') and length({x}) between {low} and {high} and regexp_matches({x}, '[{_HAN}]') "
        f"and not ({repeats_sql(x, n)}) and not regexp_matches({x}, {_re(clean.VOICE)}) and not regexp_matches({x}, {_re(_PICTURES)}), false)"
    )


_UNITS = "len(list_filter(range(1, length(x) + 1), lambda k: length(x) % k = 0 and length(x) // k >= 3 and repeat(substr(x, 1, k), length(x) // k) = x)) > 0 and not contains(x, chr(10)) and not contains(x, chr(13))"
# name: (Spark expression of x, DuckDB expression of x or None)
FUNCTIONS: dict[str, tuple[Callable[[Column], Column], str | None]] = {
    "chinese_ratio": (lambda x: F.round(clean.chinese_ratio(x), 9), f"case when length(x) > 0 then round(length({_drop(r'[^\p{L}]|[a-zA-Z]')})::double / length(x), 9) end"),
    "chinese_ratio_check": (lambda x: clean.chinese_ratio_check(x, 0.5), f"case when x is not null then coalesce(case when length(x) > 0 then length({_drop(r'[^\p{L}]|[a-zA-Z]')})::double / length(x) end >= 0.5, false) end"),
    "illegal_char_check": (lambda x: clean.illegal_char_check(x, 2), "case when x is not null then true end"),
    "illegal_char_check_strict": (lambda x: clean.illegal_char_check(x, 2, "strict"), f"length({_drop(f'[^{clean.ILLEGAL_SYMBOLS}]')}) < 2"),
    "remove_head_and_tail_symbol": (clean.remove_head_and_tail_symbol, _drop(f"[^{_WORD}]+$", _drop(f"^[^{_WORD}]+"))),
    "remove_punctuates": (clean.remove_punctuates, _drop(f"[^{_WORD}{clean.KEPT_SYMBOLS}]+$")),
    "remove_punctuates_strict": (lambda x: clean.remove_punctuates(x, "strict"), _drop(f"[^{_WORD}{clean.KEPT_SYMBOLS}]+")),
    "remove_chinese_punctuates": (clean.remove_chinese_punctuates, _drop(r"\s{2,}", _drop(f"[{_MARKS}]", "x", "' '"), "' '")),
    "replace_symbol_to_space": (clean.replace_symbol_to_space, _drop(r"\s{2,}", f"trim({_drop(f'[^{_WORD}]+', 'x', "' '")})", "' '")),
    "remove_bracket": (clean.remove_bracket, _chain(clean.BRACKET_RULES)),
    "remove_sbc": (clean.remove_sbc, _drop(r"[\x{ff00}-\x{ffff}]")),
    "only_duplicate_char_check": (lambda x: clean.only_duplicate_char_check(x, 3), f"case when x is not null then not (x = '' or ({_UNITS})) end"),
    "not_cont_duplicate_char_check": (lambda x: clean.not_cont_duplicate_char_check(x, 3), f"case when x is not null then not ({repeats_sql('x', 3)}) end"),
    "remove_voice": (clean.remove_voice, _drop(clean.VOICE)),
    "is_voice": (clean.is_voice, f"regexp_matches(x, {_re(clean.VOICE)})"),
    "remove_picture": (clean.remove_picture, _drop(_PICTURES)),
    "is_picture": (clean.is_picture, f"regexp_matches(x, {_re(_PICTURES)})"),
    "contains_chinese": (clean.contains_chinese, f"regexp_matches(x, '[{_HAN}]')"),
    "remove_qq": (clean.remove_qq, _drop("|".join(clean.QQ_MARKS))),
    "remove_face": (clean.remove_face, _drop(_FACES)),
    "remove_hex": (clean.remove_hex, _drop(clean.HEX)),
    "remove_abnormal": (clean.remove_abnormal, _drop(f"[^{_HAN}A-Za-z0-9{clean.KEPT_SYMBOLS}]")),
    "remove_meaningless": (clean.remove_meaningless, _drop("|".join(clean.MEANINGLESS))),
    "remove_line_ends": (clean.remove_line_ends, "replace(replace(x, chr(13), ''), chr(10), '')"),
    "keep_question": (clean.keep_question, f"not regexp_full_match(x, {_re('|'.join([clean.DIGITS_AS_WRITTEN, *clean.EXCLUDED_QUESTIONS]))})"),
    "keep_question_strict": (lambda x: clean.keep_question(x, "strict"), f"not regexp_full_match(x, {_re('|'.join([clean.DIGITS_INTENDED, *clean.EXCLUDED_QUESTIONS]))})"),
    "keep_faq": (clean.keep_faq, "x not in (" + ", ".join(_re(f) for f in clean.EXCLUDED_FAQS) + ")"),
    "remove_url": (clean.remove_url, _drop(clean.URL)),
    "remove_all_punctuates": (clean.remove_all_punctuates, _drop(f"[^{_WORD}]")),
    "basic_simplify": (clean.basic_simplify, basic_sql("x")),
    "simplify": (clean.simplify, simplify_sql("x")),
    "ignore_simplify": (clean.ignore_simplify, ignore_sql("x")),
    "esc": (strings.esc, r"""replace(replace(x, '\', '\\'), '"', '\"')"""),
    "remove_char": (lambda x: strings.remove_char(x, "a"), f"case when regexp_full_match(x, {_re(r'[^\n\r]*[^\p{P}a]+[^\n\r]*')}) then trim({_drop(r'[\p{P}a]+', 'x', "' '")}) else x end"),
    "is_illegal_char": (lambda x: strings.is_illegal_char(x, "a"), f"not regexp_full_match(x, {_re(r'[^\n\r]*[^\p{P}a]+[^\n\r]*')})"),
    "contain_chinese_line": (strings.contain_chinese_line, f"regexp_full_match(x, '.*[{_HAN}].*') and not contains(x, chr(13))"),
    "remove_brackets": (strings.remove_brackets, _drop(r"\)\z", _drop(r"\A\("))),
    "remove_quotations": (strings.remove_quotations, """case when contains(x, chr(10)) or contains(x, chr(13)) then x when regexp_full_match(x, '".*"') then x[2:-2] when regexp_full_match(x, '.*"') then x[:-2] when regexp_full_match(x, '".*') then x[2:] else x end"""),
    "replace_quotations": (strings.replace_quotations, """case when regexp_full_match(x, '".*"') and not contains(x, chr(13)) then x[2:-2] else x end"""),
    "is_decimal": (strings.is_decimal, f"regexp_full_match(x, {_re(strings.DECIMAL)})"),
    "is_decimal_strict": (lambda x: strings.is_decimal(x, "strict"), r"regexp_full_match(x, '[0-9]+(\.[0-9]*)?|\.[0-9]+')"),
    "is_contain_english": (strings.is_contain_english, "regexp_full_match(x, '.*[a-zA-Z]{2,}.*') and not contains(x, chr(13))"),
    "is_contain_number": (strings.is_contain_number, "regexp_full_match(x, '.*[0-9]+.*') and not contains(x, chr(13))"),
    "is_english_sentence": (strings.is_english_sentence, r"not regexp_matches(x, '[^0-9a-zA-Z\\pP]')"),
    "get_date": (strings.get_date, "coalesce(strftime(try_strptime(x, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d'), '1970-01-01')"),
    "get_time": (strings.get_time, "coalesce(strftime(try_strptime(x, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), '1970-01-01')"),
    "age_from_birth": (lambda x: strings.age_from_birth(x, 2023), "case when length(x) >= 6 then coalesce((2023 - try_cast(case when regexp_full_match(trim(substr(x, 1, 4)), '[0-9]+') then trim(substr(x, 1, 4)) end as integer))::varchar, '') else '' end"),
    "truncated": (lambda x: strings.truncated(x, 20), "case when length(x) > 20 then substr(x, 1, 20) || '......' else x end"),
    "java_split": (lambda x: strings.java_split(x, "[是的a]"), "case when x = '' then [''] else (with recursive s(v) as (select string_split_regex(x, '[是的a]') union all select v[:len(v) - 1] from s where len(v) > 0 and v[len(v)] = '') select v from s order by len(v) limit 1) end"),
}


def _query(f: Callable[[Column], Column]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "robot_log").select("log_id", _text().alias("x"))
        return rows.select("log_id", f(F.col("x")).alias("out"))

    return run


QUERIES = {f"text_{n}": _query(f) for n, (f, _) in FUNCTIONS.items()}
SQL = {f"text_{n}": f"select log_id, {s} as out from {_duck_text()}" for n, (_, s) in FUNCTIONS.items() if s}


def question_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "robot_log").select("log_id", "ex", _text().alias("x"))
    return rows.select("log_id", clean.question_check(F.col("x"), F.col("ex"), 2, 40, 4, 4).alias("out"))


def log_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences and shifts of the log's times."""
    begin, end = F.lit("2023-05-10 12:00:00"), F.col("visit_time")
    return table(spark, sf_dir, "robot_log").select(
        "log_id", strings.diff_millis(begin, end).alias("millis"), strings.diff_days(begin, end).alias("days"), strings.time_before(end, 3).alias("before"),
        strings.timestamp_millis(end).alias("epoch"), strings.date_reformat(end, strings.TIME, "yyyy/MM/dd").alias("day"),
        strings.tuple_to_string([F.col("log_id"), F.col("city"), F.col("platform")], "|").alias("tuple"),
    )


QUERIES |= {"question_check": question_check, "log_dates": log_dates}
SQL |= {
    "question_check": f"select log_id, {check_sql('x', 'ex', 2, 40)} as out from {_duck_text().replace('select log_id,', 'select log_id, ex,')}",
    "log_dates": """select log_id, coalesce(epoch_ms(t) - epoch_ms(b), 0) as millis, coalesce(abs(epoch_ms(t) - epoch_ms(b)) // 86400000, 0) as days,
      strftime(t - interval 3 days, '%Y-%m-%d %H:%M:%S') as before, epoch_ms(t) as epoch, strftime(t, '%Y/%m/%d') as day,
      log_id::varchar || '|' || coalesce(city, 'null') || '|' || coalesce(platform, 'null') as tuple
      from (select *, strptime(visit_time, '%Y-%m-%d %H:%M:%S') as t, timestamp '2023-05-10 12:00:00' as b from robot_log)""",
}

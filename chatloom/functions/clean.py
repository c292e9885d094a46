"""Text cleaning and predicates over questions, as column expressions (no Python in the data path).

Every function takes and gives a column; null stays null. Patterns are Java regular expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: patterns, phrases and marks that decide results -------------------------------------------------------------------
HAN = "一-龥"
WORD = HAN + "a-zA-Z0-9"
KEPT_SYMBOLS = "#$@*"
CHINESE_MARKS = "。；，：“”（）、？《》【】！"
ILLEGAL_SYMBOLS = "≯@Ф〇Ω×÷Π？！⊙【】☆□凵€╯╰：〈〔★…▽ˊψ━┓艹↖∞Ҿ♥◑▽￢✘《》“”‘’。"
BRACKET_RULES = [r"\[\{.*\]", r"\[\(.*\]", r"\[:.*\]", r"\[\^.*\]", r"\[[0-9].*\]", r"\[@.*\]", r"\[[iI]mage.*\]", r"\[[fF]ace.*\]"]
VOICE = ".*声音=.*amr.*"
PICTURES = [r".*图片.*[0-9A-Za-z\s]{10,}.*"] + [rf"\[(?i:Image){sign}\{{[A-Za-z0-9\-]{{10,}}\}}\.{kind}\]" for sign in ":=" for kind in ("gif", "jpg", "png")]
QQ_MARKS = [
    r"@.*\(\d{5,12}\)", r"\[CQ:at,qq=\d{5,13}\]", r"\(@[0-9]{5,12}\)", r"\[@[0-9]{5,12}\]", r"@[0-9]{5,12}\]", r"\[@[0-9]{5,12}", r"@[0-9]{5,12}\)",
    r"\(@[0-9]{5,12}", r"@[0-9]{5,12}",
]
FACES = [rf"&#91;[{HAN}]{{1,3}}&#93;", r"\[CQ:face,id=\d{1,4}\]", r"\[?(?i:face)\d{1,4}(?i:\.gif)\]?", r"\[?(?i:Face:)\d{1,3}\]?", r"(?i:原创表情.*[A-Za-z\d\s]{10,})"]
REPEATED_FACE = rf"(\[[{HAN}]{{1,3}}\])\1{{1,}}"
HEX = r"\[[A-Za-z0-9\s]{8,}\]"
MEANINGLESS = ["请您一次只问一个问题，而且尽量简短哟！", "请您一次只问一个问题，而且尽量简短哟", "请您一次只问一个问题，而且尽量简", "请您一次只问一个问题，而且尽", "请您一次只问一个问题，"]
EXCLUDED_FAQS = ["查看提问技巧", "电脑反问", "用户描述不清楚或机器人未理解", "机器人提供的方案无效果，未解决我的问题"]
EXCLUDED_QUESTIONS = (
    ".*[你您]好.* 亲.* .*[Hh]i.* .*我知道了.* .*你是谁.* .*谢谢.* .*在吗.* .*这样啊.* .*骂人.* .*请教个问题.* .*哈哈.* .*再见.* .*蠢货.* .*你看了吗.* "
    ".*答非所问.* .*回话.* .*怎么用你.* .*问什么.* .*你服务不错.* .*你个猪头.* .*神经病.* .*你个小三.* .*讨人喜欢.* .*长得好看.* .*忙么.* .*我饿了.* "
    ".*客气.* .*[早晚]上好.* .*谈.*对象.* .*结婚.* .*不理.* .*泥马.* .*妈逼.* .*你妹.* .*你大爷.* .*滚蛋.* .*去你妈.* .*草你.* .*操你.* 尼玛.*"
).split()
DIGITS_INTENDED, DIGITS_AS_WRITTEN = r"\d+", r"\\d+"
URL = r"((http|ftp|https)://)(([a-zA-Z0-9._-]+.[a-zA-Z]{2,6})|([0-9]{1,3}.[0-9]{1,3}.[0-9]{1,3}.[0-9]{1,3}))(:[0-9]{1,4})*(/[a-zA-Z0-9&%_./-~-]*)?"
# -------------------------------------------------------------------------------------------------------------------------------------


def bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with ``c`` worked out once, however often ``f`` uses it: otherwise a filter on a cleaned text repeats the cleaning for each use."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _drop(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def _guarded_drop(c: Column, pattern: str, guard: Callable[[Column], Column]) -> Column:
    """Patterns that begin with a wildcard cost the square of the length where they don't match: only texts that hold a literal they need
    are searched."""
    return bind(c, lambda x: F.when(guard(x), F.regexp_replace(x, pattern, "")).otherwise(x))


def _has(*words: str) -> Callable[[Column], Column]:
    def guard(x: Column) -> Column:
        out = x.contains(words[0])
        for w in words[1:]:
            out = out | x.contains(w)
        return out

    return guard


_may_be_voice = _has("声音=")
_may_be_picture = _has("图片", "[")


def chinese_ratio(c: Column) -> Column:
    """Letters that are no ASCII letters or digits, as a share of the length; null for the empty text (there is no ratio)."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]|[a-zA-Z]", ""))
    return F.when(F.length(c) > 0, letters / F.length(c))


def chinese_ratio_check(c: Column, threshold: float) -> Column:
    """False for the empty text."""
    return F.when(c.isNotNull(), F.coalesce(chinese_ratio(c) >= threshold, F.lit(False)))


def illegal_char_check(c: Column, n: int, mode: str = "reference") -> Column:
    """'reference': always true, as its match never binds; 'strict': false from n symbols of the class on."""
    if mode == "reference":
        return F.when(c.isNotNull(), F.lit(True))
    return F.length(F.regexp_replace(c, f"[^{ILLEGAL_SYMBOLS}]", "")) < n


def remove_head_and_tail_symbol(c: Column) -> Column:
    return _drop(_drop(c, f"^[^{WORD}]+"), f"[^{WORD}]+$")


def remove_punctuates(c: Column, mode: str = "reference") -> Column:
    """'reference': only the trailing run; 'strict': everywhere."""
    return _drop(c, f"[^{WORD}{KEPT_SYMBOLS}]+" + ("$" if mode == "reference" else ""))


def remove_chinese_punctuates(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"[{CHINESE_MARKS}]", " "), r"\s{2,}", " ")


def replace_symbol_to_space(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(c, f"[^{WORD}]+", " ")), r"\s{2,}", " ")


def remove_bracket(c: Column) -> Column:
    for rule in BRACKET_RULES:
        c = _drop(c, rule)
    return c


def remove_sbc(c: Column) -> Column:
    return _drop(c, "[＀-￿]")


def only_duplicate_char_check(c: Column, n: int) -> Column:
    """False if the whole text is one piece at least n times over (the empty text is)."""
    return ~c.rlike(rf"^(.*)\1{{{n - 1},}}$")


def not_cont_duplicate_char_check(c: Column, n: int) -> Column:
    """True if no letter or Han character stands n times in a row."""
    return ~c.rlike(rf"([{HAN}a-zA-Z])\1{{{n - 1},}}")


def remove_voice(c: Column) -> Column:
    return _guarded_drop(c, VOICE, _may_be_voice)


def is_voice(c: Column) -> Column:
    return bind(c, lambda x: _may_be_voice(x) & x.rlike(VOICE))


def remove_picture(c: Column) -> Column:
    return _guarded_drop(c, "|".join(PICTURES), _may_be_picture)


def is_picture(c: Column) -> Column:
    return bind(c, lambda x: _may_be_picture(x) & x.rlike("|".join(PICTURES)))


def contains_chinese(c: Column) -> Column:
    return c.rlike(f"[{HAN}]")


def remove_qq(c: Column) -> Column:
    return _guarded_drop(c, "|".join(QQ_MARKS), _has("@", "[CQ:at,"))


def remove_face(c: Column) -> Column:
    return _guarded_drop(c, "|".join([*FACES, REPEATED_FACE]), lambda x: _has("&#91;", "[", "原创表情")(x) | F.lower(x).contains("face"))


def remove_hex(c: Column) -> Column:
    return _guarded_drop(c, HEX, _has("["))


def remove_abnormal(c: Column) -> Column:
    return _drop(c, f"[^{HAN}A-Za-z0-9{KEPT_SYMBOLS}]")


def remove_meaningless(c: Column) -> Column:
    return _guarded_drop(c, "|".join(MEANINGLESS), _has(MEANINGLESS[-1]))


def remove_line_ends(c: Column) -> Column:
    return _drop(c, r"[\r\n]")


def keep_question(c: Column, mode: str = "reference") -> Column:
    """False for small talk that matches one of the patterns in full. In 'reference' mode the first pattern is over-escaped, so that plain
    numbers are kept; in 'strict' mode they are not."""
    digits = DIGITS_AS_WRITTEN if mode == "reference" else DIGITS_INTENDED
    return ~c.rlike(r"\A(?:" + "|".join([digits, *EXCLUDED_QUESTIONS]) + r")\z")


def keep_faq(c: Column) -> Column:
    return ~c.isin(EXCLUDED_FAQS)


def remove_url(c: Column) -> Column:
    return _drop(c, URL)


def remove_all_punctuates(c: Column) -> Column:
    """Only Han characters, letters and digits stay."""
    return _drop(c, f"[^{WORD}]")


def basic_simplify(c: Column) -> Column:
    """Voice, pictures, QQ marks, faces, hexadecimal strings and line ends, in this order."""
    for f in (remove_voice, remove_picture, remove_qq, remove_face, remove_hex, remove_line_ends):
        c = f(c)
    return c


def simplify(c: Column) -> Column:
    return F.lower(F.trim(remove_chinese_punctuates(basic_simplify(remove_meaningless(c)))))


def ignore_simplify(c: Column) -> Column:
    return F.lower(F.trim(remove_abnormal(remove_head_and_tail_symbol(basic_simplify(c)))))


def empty_ex(ex: Column) -> Column:
    """null, the empty text and the word null all mean that there is nothing."""
    return ex.isNull() | (F.lower(ex) == "null") | (F.trim(ex) == "")


def question_check(c: Column, ex: Column, low: int = 0, high: int = 60, illegal: int = 4, repeat: int = 4, mode: str = "reference") -> Column:
    """Whether a question is worth working on. False for null."""
    ok = empty_ex(ex) & F.length(c).between(low, high) & contains_chinese(c) & illegal_char_check(c, illegal, mode) & not_cont_duplicate_char_check(c, repeat) & ~is_voice(c) & ~is_picture(c)
    return F.coalesce(ok, F.lit(False))


normal_check = question_check

"""Unanswered questions: type override, filters, counts over periods, question and FAQ mapping.

The log is a DataFrame with the robot-log columns. Periods end with the reference day and are predicates on the visit date, never today's
date. Several periods are counted in one scan by conditional aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions import clean

#: Types that count as unanswered: none, and suggested.
UNANSWERED = (0, 11)
PERIODS = (1, 7, 30)
QUESTION_LENGTHS = (2, 40)
MAPPING_LENGTHS = (2, 50)
ANSWERED_ABOVE = 0.73


def visit_date(c: Column | None = None) -> Column:
    return F.to_date(F.substring(F.col("visit_time") if c is None else c, 1, 10))


def in_days(date: Column, ref: str, days: int) -> Column:
    """Whether a date is one of the ``days`` days that end with ``ref``."""
    end = F.lit(ref).cast("date")
    return date.between(F.date_sub(end, days - 1), end)


def in_period(date: Column, ref: str, period: str) -> Column:
    """Periods '10d' or '6m' that end with ``ref``; as documented, n months reach over n + 1 calendar months. Others: all."""
    end = F.lit(ref).cast("date")
    if period.endswith("d"):
        return in_days(date, ref, int(period[:-1]))
    if period.endswith("m"):
        return date.between(F.trunc(F.add_months(end, -int(period[:-1])), "month"), F.last_day(end))
    return F.lit(True)


def target_date(today: str, text: str) -> Column:
    """'0' is the day before ``today``; else the date of the form yyyy/MM/dd."""
    return F.date_sub(F.lit(today).cast("date"), 1) if text == "0" else F.to_date(F.lit(text), "yyyy/MM/dd")


def contains_any(c: Column, phrases: list[str]) -> Column:
    """Whether a text holds one of the phrases; false for null."""
    hit = F.lit(False)
    for p in phrases:
        hit = hit | F.coalesce(c.contains(p), F.lit(False))
    return hit


def answer_type(excluded_faqs: list[str] | None, unclear: list[str]) -> Column:
    """0 for an excluded FAQ or an unclear answer, else the row's own type (null if it is no integer)."""
    own = F.col("answer_type").try_cast("int")
    out = F.when(contains_any(F.col("answer"), unclear), 0).otherwise(own)
    return F.when(F.coalesce(F.col("faq_name").isin(excluded_faqs), F.lit(False)), 0).otherwise(out) if excluded_faqs else out


def about_domain(c: Column, words: list[str]) -> Column:
    """Whether a text holds a domain word and more than it, and is none itself."""
    low = F.lower(c)
    return F.coalesce(contains_longer(low, words) & ~low.isin(words), F.lit(False))


def contains_longer(low: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | (low.contains(w) & (F.length(F.trim(low)) > len(w)))
    return hit


def drop_ignored(df: DataFrame, text: str, ignored: DataFrame) -> DataFrame:
    """Rows whose short form is none of the ignored questions' (a left anti join; the optimizer broadcasts a list it knows to be small)."""
    short = ignored.select(clean.ignore_simplify(F.col(ignored.columns[0])).alias("_short")).where("_short <> ''").distinct()
    return df.withColumn("_key", clean.ignore_simplify(F.col(text))).join(short, F.col("_key") == F.col("_short"), "left_anti").drop("_key")


def checked(rows: DataFrame, question: Column, good: Callable[[Column], Column]) -> DataFrame:
    """Rows whose question is good, with it in column ``question``."""
    both = clean.bind(question, lambda q: F.struct(q.alias("q"), good(q).alias("ok")))
    return rows.withColumn("_q", both).where("_q.ok").withColumn("question", F.col("_q.q")).drop("_q")


def unanswered(log: DataFrame, ref: str, days: int, excluded_faqs: list[str], unclear: list[str], ignored: DataFrame, domain: list[str]) -> DataFrame:
    """The period's unanswered questions worth a look: question (simplified), type, original, visit_time, session_id, log_id."""
    rows = log.where(in_days(visit_date(), ref, days)).select(
        "log_id", "visit_time", "session_id", "ex", F.trim("question").alias("original"), answer_type(excluded_faqs, unclear).alias("type")
    )
    good = lambda q: clean.question_check(q, F.col("ex"), *QUESTION_LENGTHS) & about_domain(q, domain) & (F.length(q) > 2)
    rows = checked(rows.where(F.col("type").isin(*UNANSWERED)), clean.simplify(F.col("original")), good)
    return drop_ignored(rows, "original", ignored).select("question", "type", "original", "visit_time", "session_id", "log_id")


def counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def type_counts(rows: DataFrame) -> DataFrame:
    """Unanswered and suggested rows of each question."""
    return rows.groupBy("question").agg(F.count_if(F.col("type") == 0).alias("cnt0"), F.count_if(F.col("type") == 11).alias("cnt11"))


def strongest_type(rows: DataFrame) -> DataFrame:
    """A question that was both unanswered and suggested counts as unanswered."""
    return rows.groupBy("question").agg(F.min("type").alias("type"))


def period_counts(log: DataFrame, ref: str, excluded_faqs: list[str], unclear: list[str], first_day: DataFrame | None = None, periods: tuple = PERIODS) -> DataFrame:
    """cnt0 and cnt11 of each question over the three periods in one scan; only questions of the first period come out (those of
    ``first_day``, if given)."""
    date = visit_date()
    rows = log.where(in_days(date, ref, max(periods))).select(date.alias("date"), "ex", F.col("question").alias("original"), answer_type(excluded_faqs, unclear).alias("type"))
    rows = checked(rows.where(F.col("type").isin(*UNANSWERED)), clean.simplify(F.col("original")), lambda q: clean.question_check(q, F.col("ex"), *QUESTION_LENGTHS))
    here = lambda days, kind: F.count_if(in_days(F.col("date"), ref, days) & (F.col("type") == kind))
    out = rows.groupBy("question").agg(*[here(d, k).alias(f"cnt{k}_{d}d") for k in UNANSWERED for d in periods])
    if first_day is not None:
        return out.join(first_day.select("question").distinct(), "question", "left_semi")
    return out.where(F.col(f"cnt0_{min(periods)}d") + F.col(f"cnt11_{min(periods)}d") > 0)


def question_map(rows: DataFrame) -> DataFrame:
    """Each question with its originals and counts."""
    each = rows.groupBy("question", "original").agg(F.count_if(F.col("type") == 0).alias("n0"), F.count_if(F.col("type") == 11).alias("n11"))
    whole = W.partitionBy("question")  # one row per original is left: the log is read and cleaned once
    return each.select("question", "original", F.sum("n0").over(whole).alias("cnt0"), F.sum("n11").over(whole).alias("cnt11"))


def question_faq(log: DataFrame, excluded_faqs: list[str], above: float = ANSWERED_ABOVE) -> DataFrame:
    """Each question and original with the FAQ of its last answered row (else of its last row), whether one answered it, and the
    question's number of originals. Rows are ordered by time and log_id."""
    rows = log.select(
        F.col("question").alias("original"), F.coalesce("faq_name", F.lit("")).alias("faq"), "ex",
        F.col("similarity").try_cast("double").alias("sim"), "visit_time", "log_id",
    )
    rows = checked(rows.where(~F.col("faq").isin(excluded_faqs)), clean.simplify(F.col("original")), lambda q: clean.question_check(q, F.col("ex"), *MAPPING_LENGTHS))
    rows = rows.withColumn("answered", F.coalesce((F.col("sim") > above) & (F.trim("faq") != ""), F.lit(False)))
    out = rows.groupBy("question", "original").agg(F.bool_or("answered").alias("answered"), F.max_by("faq", F.struct("answered", "visit_time", "log_id")).alias("faq"))
    return out.withColumn("n_originals", F.count("*").over(W.partitionBy("question")))


def faq_ids(log: DataFrame) -> DataFrame:
    """The latest and the first identifier of each FAQ name."""
    rows = log.where(F.trim("faq_name") != "")
    return rows.groupBy("faq_name").agg(F.max_by("faq_id", F.struct("visit_time", "log_id")).alias("latest_id"), F.min("faq_id").alias("first_id"))

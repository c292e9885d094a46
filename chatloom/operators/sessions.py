"""Sessions: timelines, suggestions that were taken, hand-offs to people, counts and details.

Rows of a session are ordered by visit_time and log_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions.strings import truncated
from chatloom.operators.unanswered import answer_type, contains_any, visit_date

# FAQs that ask back, with the similarity below which they are no answer.
ASKING_BACK = {"电脑反问": 0.9, "手机反问": 0.7, "打印机反问": 0.7}
NOT_UNDERSTOOD = " 用户描述不清楚或机器人未理解"
CHAT = (4, 8)
KEPT_SESSIONS = 5
HANDOFF_LEVELS = (40, 30, 20)


def timeline(log: DataFrame) -> DataFrame:
    """Each row's place in its session, from 0."""
    return log.withColumn("place", F.row_number().over(W.partitionBy("session_id").orderBy("visit_time", "log_id")) - 1)


def suggestion_hits(log: DataFrame, excluded: list[str]) -> DataFrame:
    """Suggested rows (type 11) with the session's next suggested question at a later time, and whether the answer had offered it."""
    rows = log.where(F.col("answer_type").try_cast("int") == 11).select("session_id", "visit_time", "log_id", "question", "answer")
    times = rows.groupBy("session_id", "visit_time").agg(F.min_by("question", "log_id").alias("first"))
    later = times.withColumn("next_question", F.lead("first").over(W.partitionBy("session_id").orderBy("visit_time"))).drop("first")
    hit = F.col("answer").contains(F.col("next_question")) & ~F.col("next_question").isin(excluded)
    return rows.join(later, ["session_id", "visit_time"]).select("log_id", "session_id", "question", "next_question", F.coalesce(hit, F.lit(False)).alias("hit"))


def click_rate(hits: DataFrame) -> DataFrame:
    return hits.groupBy("question").agg(F.avg(F.col("hit").cast("double")).alias("rate"), F.count_if("hit").alias("n_hit"), F.count_if(~F.col("hit")).alias("n_miss"))


def weak_answer() -> Column:
    """No answer, a suggestion, or an FAQ that asks back with too low a similarity (an unparsable one counts as low)."""
    sim = F.col("similarity").try_cast("double")
    out = F.col("answer_type").isin("0", "11") | (F.col("faq_name") == NOT_UNDERSTOOD)
    for faq, below in ASKING_BACK.items():
        out = out | ((F.col("faq_name") == faq) & F.coalesce(sim < below, F.lit(True)))
    return F.coalesce(out, F.lit(False))


def handoffs(log: DataFrame, faq: str, mode: str = "reference") -> DataFrame:
    """Sessions with a hand-off: the first one's place, whether it was direct, and whether the user began it.

    direct: at place 0; in 'strict' mode also if only chat precedes it (in 'reference' mode that test never holds). initiated: at place 0,
    or all rows up to it are of type 8."""
    kind = F.col("answer_type").try_cast("int")
    rows = timeline(log).select("session_id", "place", kind.alias("kind"), F.coalesce(F.col("faq_name") == faq, F.lit(False)).alias("here"))
    first = F.min(F.when(F.col("here"), F.col("place"))).over(W.partitionBy("session_id"))
    upto = rows.withColumn("first", first).where("first is not null and place <= first")
    out = upto.groupBy("session_id").agg(
        F.max("first").alias("first"), F.bool_and(F.coalesce(F.col("kind") == 8, F.lit(False))).alias("only_custom"),
        F.bool_and(F.coalesce(F.col("kind").isin(*CHAT), F.lit(False)) | (F.col("place") == F.col("first"))).alias("only_chat"),
    )
    direct = (F.col("first") == 0) | (F.col("only_chat") if mode == "strict" else F.lit(False))
    return out.select("session_id", "first", direct.alias("direct"), ((F.col("first") == 0) | F.col("only_custom")).alias("initiated"))


def handoff_counts(log: DataFrame, faq: str) -> DataFrame:
    """Sessions of each question among those that were handed off, not directly, and had an unanswered row."""
    keep = handoffs(log, faq).where("not direct").select("session_id")
    failed = log.where(F.col("answer_type").isin("0", "11")).select("session_id").distinct()
    rows = log.join(keep, "session_id", "left_semi").join(failed, "session_id", "left_semi")
    return rows.groupBy("question").agg(F.count_distinct("session_id").alias("n_sessions"))


def handoff_distances(log: DataFrame, faq: str) -> DataFrame:
    """For each session handed off not at the user's wish, and each question with a weak answer in it: the least distance in rows from the
    question to a hand-off, and the day of that row (of equal distances the earliest row's)."""
    # All windows are over the session: one exchange, and no joining of the log with itself.
    whole = W.partitionBy("session_id")
    custom = F.coalesce(F.col("answer_type").try_cast("int") == 8, F.lit(False))
    rows = timeline(log).select("session_id", "question", "place", visit_date().alias("day"), weak_answer().alias("weak"), F.coalesce(F.col("faq_name") == faq, F.lit(False)).alias("here"), custom.alias("custom"))
    rows = rows.where("session_id is not null").withColumn("first", F.min(F.when(F.col("here"), F.col("place"))).over(whole)).where("first is not null")
    initiated = (F.col("first") == 0) | F.min(F.when(F.col("place") <= F.col("first"), F.col("custom"))).over(whole)
    rows = rows.withColumn("initiated", initiated).where("not initiated")
    # The nearest hand-offs before and after a row are running maxima and minima: no pairing of rows within a session.
    order = W.partitionBy("session_id").orderBy("place")
    at = F.when(F.col("here"), F.col("place"))
    before = F.max(at).over(order.rowsBetween(W.unboundedPreceding, 0))
    after = F.min(at).over(W.partitionBy("session_id").orderBy(F.desc("place")).rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("distance", F.least(F.col("place") - before, after - F.col("place")))
    any_weak = F.max("weak").over(W.partitionBy("session_id", "question"))
    rows = rows.withColumn("weak", any_weak).where("weak and question is not null")
    return rows.groupBy("session_id", "question").agg(F.min("distance").alias("distance"), F.min_by("day", F.struct("distance", "place")).alias("day"))


def bucketed(value: Column, steps: list[tuple[int, int]], rest: int) -> Column:
    """The score of the first step a value doesn't exceed."""
    out = F.when(value <= steps[0][0], steps[0][1])
    for limit, score in steps[1:]:
        out = out.when(value <= limit, score)
    return out.otherwise(rest)


def handoff_scores(distances: DataFrame, ref: str, levels: tuple[int, int, int] = HANDOFF_LEVELS) -> DataFrame:
    """Weight of each question by its distances to hand-offs and the days up to ``ref``, with a level from 3 (heavy) to 0."""
    near = F.when(F.col("distance") == 1, 20).otherwise(bucketed(F.col("distance"), [(4, 10), (10, 5)], 1))
    late = bucketed(F.datediff(F.lit(ref).cast("date"), F.col("day")), [(0, 20), (3, 10), (7, 5)], 1)
    score = distances.groupBy("question").agg(F.sum(near + late).alias("score"))
    level = F.lit(0)
    for k, least in enumerate(sorted(levels)):
        level = F.when(F.col("score") >= least, k + 1).otherwise(level)
    return score.withColumn("level", level)


def type_counts_and_sessions(log: DataFrame, unclear: list[str], keep: int = KEPT_SESSIONS) -> DataFrame:
    """Rows of each question by answer type (1, 0, 11, other u) and its latest ``keep`` sessions by type: sessions are ordered by their
    first row's time (then by name), and the last ones come in that order."""
    kind = F.when(answer_type(None, unclear).isin(1, 0, 11), answer_type(None, unclear).cast("string")).otherwise("u")
    rows = log.where(F.col("question").isNotNull()).select("question", kind.alias("kind"), "session_id", "visit_time")
    firsts = rows.groupBy("question", "kind", "session_id").agg(F.count("*").alias("n"), F.min("visit_time").alias("since"))
    last = F.row_number().over(W.partitionBy("question", "kind").orderBy(F.desc("since"), F.desc("session_id")))
    ranked = firsts.withColumn("last", last)
    one = ranked.groupBy("question", "kind").agg(
        F.sum("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.when(F.col("last") <= keep, F.struct("since", "session_id")))), lambda x: x["session_id"]).alias("ids")
    )
    wide = one.groupBy("question").agg(*[
        e for k in ("1", "0", "11", "u")
        for e in (F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"cnt_{k}"), F.coalesce(F.max(F.when(F.col("kind") == k, F.array_join("ids", ","))), F.lit("")).alias(f"sessions_{k}"))
    ])
    return wide


def session_details(log: DataFrame) -> DataFrame:
    """Each session's rows as a JSON array in their order; long answers are cut."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    row = F.struct(text("visit_time").alias("visittime"), text("question").alias("question"), truncated(text("answer"), 100, "...").alias("answer"), text("faq_name").alias("faq"), text("platform").alias("platform"))
    rows = log.select("session_id", F.struct("visit_time", "log_id", row.alias("row")).alias("r"))
    return rows.groupBy("session_id").agg(F.to_json(F.transform(F.sort_array(F.collect_list("r")), lambda x: x["row"])).alias("detail"))


def platforms(log: DataFrame, ref: str, unclear: list[str]) -> DataFrame:
    """Platforms of the questions that were unanswered on the reference day: that day's, and those of answered and unanswered rows overall."""
    failed = answer_type(None, unclear).isin(0, 11) | contains_any(F.col("answer"), unclear)
    rows = log.where(F.col("question").isNotNull()).select("question", F.coalesce("platform", F.lit("")).alias("platform"), F.coalesce(failed, F.lit(False)).alias("failed"), (visit_date() == F.lit(ref).cast("date")).alias("today"))
    joined = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("platform")))), ",")
    out = rows.groupBy("question").agg(joined(F.col("today") & F.col("failed")).alias("today"), joined(~F.col("failed")).alias("answered"), joined(F.col("failed")).alias("unanswered"), F.bool_or(F.col("today") & F.col("failed")).alias("keep"))
    return out.where("keep").drop("keep")

"""Queries of the log operators with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import clean
from chatloom.operators import sessions as se
from chatloom.operators import unanswered as un
from chatloom.plans.text_queries import check_sql, ignore_sql, simplify_sql
from chatloom.runtime import table

# Parameters of these queries (the reference takes them from files).
REF = "2023-05-30"
UNCLEAR = ["小助手没听懂，请换个说法", "抱歉，我还没有学会这个问题", "无法解答"]
EXCLUDED_FAQS = ["转人工服务", "密码重置说明"]
EXCLUDED_SUGGESTIONS = ["转人工"]
IGNORED = ["在吗", "你好呢", "转人工。", "蓝牙失败怎么办!"]
DOMAIN = ["平板", "路由器", "手表", "净水器", "电视", "空调", "手机", "耳机", "投影仪", "打印机", "蓝牙", "音箱"]
HANDOFF = "转人工服务"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "robot_log")


def _ignored(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in IGNORED], "question string")


def _unanswered(spark: SparkSession, sf_dir: str, days: int = 7) -> DataFrame:
    return un.unanswered(_log(spark, sf_dir), REF, days, EXCLUDED_FAQS, UNCLEAR, _ignored(spark), DOMAIN)


def _list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _any(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"coalesce(contains({x}, {_list([w])}), false)" for w in words) + ")"


def _type(excluded: bool) -> str:
    first = f"when faq_name in ({_list(EXCLUDED_FAQS)}) then 0 " if excluded else ""
    return f"case {first}when {_any('answer', UNCLEAR)} then 0 else try_cast(answer_type as integer) end"


def _days(days: int, date: str = "cast(substr(visit_time, 1, 10) as date)") -> str:
    return f"{date} between date '{REF}' - {days - 1} and date '{REF}'"


def _unanswered_sql(days: int = 7) -> str:
    low = "lower(question)"
    about = "(" + " or ".join(f"(contains({low}, '{w}') and length(trim({low})) > {len(w)})" for w in DOMAIN) + f") and {low} not in ({_list(DOMAIN)})"
    return f"""
      base as (select log_id, visit_time, session_id, ex, trim(question) as original, {_type(True)} as type from robot_log where {_days(days)}),
      simple as (select *, {simplify_sql('original')} as question from base where type in (0, 11)),
      ignored as (select {ignore_sql('q')} as short from (values {', '.join(f"('{x}')" for x in IGNORED)}) t(q)),
      un as (select question, type, original, visit_time, session_id, log_id from simple where {check_sql('question', 'ex', 2, 40)} and {about} and length(question) > 2
        and {ignore_sql('original')} not in (select short from ignored))"""


QUERIES, SQL = {}, {}


def _add(name: str, f, sql: str | None = None) -> None:
    QUERIES[name] = f
    if sql:
        SQL[name] = sql


_add("unanswered_rows", _unanswered, f"with {_unanswered_sql()} select * from un")
_add("unanswered_counts", lambda s, d: un.counts(_unanswered(s, d), "question"), f"with {_unanswered_sql()} select question, count(*) as n from un group by 1")
_add(
    "unanswered_by_day", lambda s, d: _unanswered(s, d, 30).groupBy(un.visit_date().alias("day")).agg(F.count_if(F.col("type") == 0).alias("cnt0"), F.count_if(F.col("type") == 11).alias("cnt11"), F.count_distinct("question").alias("n_questions")),
    f"with {_unanswered_sql(30)} select cast(substr(visit_time, 1, 10) as date) as day, count(*) filter (type = 0) as cnt0, count(*) filter (type = 11) as cnt11, count(distinct question) as n_questions from un group by 1",
)
_add("type_counts", lambda s, d: un.type_counts(_unanswered(s, d)), f"with {_unanswered_sql()} select question, count(*) filter (type = 0) as cnt0, count(*) filter (type = 11) as cnt11 from un group by 1")
_add("strongest_type", lambda s, d: un.strongest_type(_unanswered(s, d)), f"with {_unanswered_sql()} select question, min(type) as type from un group by 1")
_add("question_map", lambda s, d: un.question_map(_unanswered(s, d)), f"""with {_unanswered_sql()}, c as (select question, count(*) filter (type = 0) as cnt0, count(*) filter (type = 11) as cnt11 from un group by 1)
  select question, cnt0, cnt11, original from c join (select distinct question, original from un) using (question)""")  # fmt: skip
_P = [f"count(*) filter (type = {k} and {_days(d, 'date')}) as cnt{k}_{d}d" for k in (0, 11) for d in (1, 7, 30)]
_add("period_counts", lambda s, d: un.period_counts(_log(s, d), REF, EXCLUDED_FAQS, UNCLEAR), f"""with b as (select cast(substr(visit_time, 1, 10) as date) as date, ex, {simplify_sql('question')} as question, {_type(True)} as type from robot_log where {_days(30)}),
  c as (select question, {', '.join(_P)} from b where type in (0, 11) and {check_sql('question', 'ex', 2, 40)} group by 1) select * from c where cnt0_1d + cnt11_1d > 0""")  # fmt: skip
_add("question_faq", lambda s, d: un.question_faq(_log(s, d), EXCLUDED_FAQS), f"""with r as (select {simplify_sql('question')} as question, question as original, coalesce(faq_name, '') as faq, ex, try_cast(similarity as double) as sim, visit_time, log_id from robot_log),
  a as (select *, coalesce(sim > 0.73 and trim(faq) <> '', false) as answered from r where {check_sql('question', 'ex', 2, 50)} and faq not in ({_list(EXCLUDED_FAQS)})),
  g as (select question, original, bool_or(answered) as answered, arg_max(faq, row(answered, visit_time, log_id)) as faq from a group by 1, 2)
  select *, count(*) over (partition by question) as n_originals from g""")  # fmt: skip
_add("faq_ids", lambda s, d: un.faq_ids(_log(s, d)), "select faq_name, arg_max(faq_id, row(visit_time, log_id)) as latest_id, min(faq_id) as first_id from robot_log where trim(faq_name) <> '' group by 1")
_add("period_days", lambda s, d: _log(s, d).where(un.in_period(un.visit_date(), REF, "10d")).groupBy(un.visit_date().alias("day")).count().withColumnRenamed("count", "n"), f"select cast(substr(visit_time, 1, 10) as date) as day, count(*) as n from robot_log where {_days(10)} group by 1")
_add("period_months", lambda s, d: _log(s, d).where(un.in_period(un.visit_date(), REF, "0m")).groupBy(F.substring("visit_time", 1, 7).alias("month")).count().withColumnRenamed("count", "n"), "select substr(visit_time, 1, 7) as month, count(*) as n from robot_log where substr(visit_time, 1, 7) = '2023-05' group by 1")
_add("target_day", lambda s, d: _log(s, d).where(un.visit_date() == un.target_date("2023-05-11", "0")).select("log_id", "visit_time"), "select log_id, visit_time from robot_log where substr(visit_time, 1, 10) = '2023-05-10'")

_T = "t as (select *, row_number() over (partition by session_id order by visit_time, log_id) - 1 as place from robot_log)"
_add("session_timeline", lambda s, d: se.timeline(_log(s, d)).select("log_id", "session_id", "place"), f"with {_T} select log_id, session_id, place from t")
_HITS = f"""r as (select * from robot_log where try_cast(answer_type as integer) = 11), m as (select session_id, visit_time, arg_min(coalesce(question, chr(0)), log_id) as f0 from r group by 1, 2),
  l as (select session_id, visit_time, nullif(lead(f0) over (partition by session_id order by visit_time), chr(0)) as next_question from m),
  h as (select log_id, r.session_id, question, next_question, coalesce(contains(answer, next_question) and next_question not in ({_list(EXCLUDED_SUGGESTIONS)}), false) as hit from r join l using (session_id, visit_time))"""
_add("suggestion_hits", lambda s, d: se.suggestion_hits(_log(s, d), EXCLUDED_SUGGESTIONS), f"with {_HITS} select * from h")
_add("click_rate", lambda s, d: se.click_rate(se.suggestion_hits(_log(s, d), EXCLUDED_SUGGESTIONS)).withColumn("rate", F.round("rate", 9)), f"with {_HITS} select question, round(avg(hit::integer), 9) as rate, count(*) filter (hit) as n_hit, count(*) filter (not hit) as n_miss from h group by 1")
_HAND = f"""{_T}, f as (select *, try_cast(answer_type as integer) as kind, min(case when faq_name = '{HANDOFF}' then place end) over (partition by session_id) as first from t),
  hand as (select session_id, max(first) as first, max(first) = 0 or (DIRECT) as direct, max(first) = 0 or bool_and(coalesce(kind = 8, false)) as initiated from f where place <= first group by 1)"""
_ref, _strict = _HAND.replace("DIRECT", "false"), _HAND.replace("DIRECT", "bool_and(coalesce(kind in (4, 8), false) or place = first)")
_add("handoff_sessions", lambda s, d: se.handoffs(_log(s, d), HANDOFF), f"with {_ref} select * from hand")
_add("handoff_sessions_strict", lambda s, d: se.handoffs(_log(s, d), HANDOFF, "strict"), f"with {_strict} select * from hand")
_add("handoff_counts", lambda s, d: se.handoff_counts(_log(s, d), HANDOFF), f"""with {_ref} select question, count(distinct session_id) as n_sessions from robot_log where session_id in (select session_id from hand where not direct)
  and session_id in (select session_id from robot_log where answer_type in ('0', '11')) group by 1""")  # fmt: skip
_WEAK = "(answer_type in ('0', '11') or faq_name = ' 用户描述不清楚或机器人未理解' or " + " or ".join(f"(faq_name = '{f}' and coalesce(try_cast(similarity as double) < {b}, true))" for f, b in se.ASKING_BACK.items()) + ")"
_DIST = f"""{_ref}, s as (select session_id, question, place, cast(substr(visit_time, 1, 10) as date) as day, coalesce({_WEAK}, false) as weak, coalesce(faq_name = '{HANDOFF}', false) as here from t where session_id in (select session_id from hand where not initiated)),
  w as (select distinct session_id, question from s where weak and question is not null),
  p as (select s.session_id, s.question, s.place, s.day, min(abs(s.place - h.place)) as distance from s join w using (session_id, question) join s h on h.session_id = s.session_id and h.here group by all),
  dist as (select session_id, question, min(distance) as distance, arg_min(day, row(distance, place)) as day from p group by 1, 2)"""
_add("handoff_distances", lambda s, d: se.handoff_distances(_log(s, d), HANDOFF), f"with {_DIST} select * from dist")
_SCORES = f"select question, sum(case when distance = 1 then 20 when distance <= 4 then 10 when distance <= 10 then 5 else 1 end + case when date '{REF}' - day <= 0 then 20 when date '{REF}' - day <= 3 then 10 when date '{REF}' - day <= 7 then 5 else 1 end) as score from dist group by 1"
_LEVELED = f"select question, score, case when score >= 40 then 3 when score >= 30 then 2 when score >= 20 then 1 else 0 end as level from ({_SCORES})"
_add("handoff_scores", lambda s, d: se.handoff_scores(se.handoff_distances(_log(s, d), HANDOFF), REF), f"with {_DIST} {_LEVELED}")
_add("weak_answers", lambda s, d: _log(s, d).select("log_id", se.weak_answer().alias("weak")), f"select log_id, coalesce({_WEAK}, false) as weak from robot_log")
_KINDS = f"""k as (select question, case when ({_type(False)}) in (1, 0, 11) then ({_type(False)})::varchar else 'u' end as kind, session_id, visit_time from robot_log where question is not null),
  g as (select question, kind, session_id, count(*) as n, min(visit_time) as since from k group by all),
  r as (select *, row_number() over (partition by question, kind order by since desc, session_id desc) as last from g)"""
_WIDE = ", ".join(f"coalesce(sum(n) filter (kind = '{k}'), 0)::bigint as cnt_{k}, coalesce(string_agg(session_id, ',' order by since, session_id) filter (kind = '{k}' and last <= 5), '') as sessions_{k}" for k in ("1", "0", "11", "u"))
_add("type_counts_and_sessions", lambda s, d: se.type_counts_and_sessions(_log(s, d), UNCLEAR), f"with {_KINDS} select question, {_WIDE} from r group by 1")
_add("session_details", lambda s, d: se.session_details(_log(s, d)), """with r as (select session_id, visit_time, log_id, json_object('visittime', coalesce(visit_time, ''), 'question', coalesce(question, ''),
  'answer', case when length(answer) > 100 then substr(answer, 1, 100) || '...' else coalesce(answer, '') end, 'faq', coalesce(faq_name, ''), 'platform', coalesce(platform, ''))::varchar as j from robot_log)
  select session_id, '[' || string_agg(j, ',' order by visit_time, log_id) || ']' as detail from r group by 1""")  # fmt: skip
_add("platform_sets", lambda s, d: se.platforms(_log(s, d), REF, UNCLEAR), f"""with p as (select question, coalesce(platform, '') as platform, coalesce(({_type(False)}) in (0, 11), false) or {_any('answer', UNCLEAR)} as failed, substr(visit_time, 1, 10) = '{REF}' as today from robot_log where question is not null)
  select question, string_agg(distinct platform, ',' order by platform) filter (today and failed) as today, coalesce(string_agg(distinct platform, ',' order by platform) filter (not failed), '') as answered,
  coalesce(string_agg(distinct platform, ',' order by platform) filter (failed), '') as unanswered from p group by 1 having bool_or(today and failed)""")  # fmt: skip
# Projections, null handling, joins and sets over the log.
_add("fill_nulls", lambda s, d: table(s, d, "retail_action").na.fill("0", ["vipno", "qty", "amt"]).select("uid", "vipno", "qty", "amt"), "select uid, coalesce(vipno, '0') as vipno, coalesce(qty, '0') as qty, coalesce(amt, '0') as amt from retail_action")
_add("answer_types", lambda s, d: _log(s, d).select("log_id", un.answer_type(EXCLUDED_FAQS, UNCLEAR).alias("type")), f"select log_id, {_type(True)} as type from robot_log")
_add("faq_join", lambda s, d: _log(s, d).select("log_id", "faq_name").join(un.faq_ids(_log(s, d)), "faq_name").select("log_id", "latest_id"), "select log_id, latest_id from robot_log join (select faq_name, arg_max(faq_id, row(visit_time, log_id)) as latest_id from robot_log where trim(faq_name) <> '' group by 1) using (faq_name)")
_add("faq_left_join", lambda s, d: _log(s, d).select("log_id", "faq_name").join(un.faq_ids(_log(s, d)), "faq_name", "left").select("log_id", F.coalesce("latest_id", F.lit("")).alias("latest_id")), "select log_id, coalesce(latest_id, '') as latest_id from robot_log left join (select faq_name, arg_max(faq_id, row(visit_time, log_id)) as latest_id from robot_log where trim(faq_name) <> '' group by 1) using (faq_name)")
_add("anti_join", lambda s, d: _log(s, d).select("log_id", "question").join(_log(s, d).where("answer_type in ('0', '11')").select("question").distinct(), "question", "left_anti").select("log_id"), "select log_id from robot_log r where not exists (select 1 from robot_log x where x.answer_type in ('0', '11') and x.question = r.question)")
_add("semi_join", lambda s, d: _log(s, d).select("log_id", "session_id").join(_log(s, d).where(F.col("faq_name") == HANDOFF).select("session_id").distinct(), "session_id", "left_semi").select("log_id"), f"select log_id from robot_log where session_id in (select session_id from robot_log where faq_name = '{HANDOFF}')")
_add("union_all", lambda s, d: _log(s, d).select("question").unionByName(table(s, d, "std_question").select("question")).groupBy("question").agg(F.count("*").alias("n")), "select question, count(*) as n from (select question from robot_log union all select question from std_question) group by 1")
_add("subtract", lambda s, d: _log(s, d).select("question").exceptAll(_log(s, d).where("answer_type = '1'").select("question")).groupBy("question").agg(F.count("*").alias("n")), "select question, count(*) as n from (select question from robot_log except all select question from robot_log where answer_type = '1') group by 1")
_add("distinct_questions", lambda s, d: _log(s, d).select("question").distinct(), "select distinct question from robot_log")
_add("sum_per_key", lambda s, d: table(s, d, "retail_action").groupBy("prodno", "site_no").agg(F.sum(F.col("qty").try_cast("long")).alias("qty")), "select prodno, site_no, sum(try_cast(qty as bigint))::bigint as qty from retail_action group by 1, 2")
_add("collect_sets", lambda s, d: _log(s, d).where("faq_name <> ''").groupBy("faq_name").agg(F.array_join(F.array_sort(F.collect_set("platform")), ",").alias("platforms"), F.count_distinct("city").alias("n_cities")), "select faq_name, coalesce(string_agg(distinct platform, ',' order by platform), '') as platforms, count(distinct city) as n_cities from robot_log where faq_name <> '' group by 1")
_add("row_numbers", lambda s, d: _numbered(s, d), "select question, log_id, row_number() over (order by log_id) - 1 as number from (select question, min(log_id) as log_id from robot_log where question is not null group by 1)")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatloom.operators.ranking import numbered

    firsts = _log(spark, sf_dir).where("question is not null").groupBy("question").agg(F.min("log_id").alias("log_id"))
    return numbered(firsts, ["log_id"], "number")

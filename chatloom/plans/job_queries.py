"""Every output of every job, and the streaming extension, as queries."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom import runtime
from chatloom.functions import clean
from chatloom.plans import jobs
from chatloom.plans import log_queries as lq
from chatloom.plans import pair_queries as pq
from chatloom.runtime import scratch_path, table
from chatloom.streaming import counts as sc

WEIGHTS = [(w, 1.0 - 0.0625 * i) for i, w in enumerate(lq.DOMAIN)]
CONFIG = jobs.JobConfig(ref=lq.REF, excluded_faqs=lq.EXCLUDED_FAQS, excluded_suggestions=lq.EXCLUDED_SUGGESTIONS, unclear=lq.UNCLEAR, ignored=lq.IGNORED, domain=lq.DOMAIN, keyword_weights=WEIGHTS)
_HELD: dict[tuple, dict[str, DataFrame]] = {}


def _config(spark: SparkSession, sf_dir: str) -> jobs.JobConfig:
    """The lists, with labels of the log's own questions for the import and a classifier's lines made from the log."""
    log = table(spark, sf_dir, "robot_log")
    labels = log.select(clean.simplify(F.col("question")).alias("cleaned"), "sentiment").where("cleaned <> ''").groupBy("cleaned").agg(F.max(F.coalesce("sentiment", F.lit(""))).alias("label"))
    return dataclasses.replace(CONFIG, classified=[pq._parsed(spark, sf_dir)], tables={"labels": labels})


def _outputs(name: str):
    def run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
        # The outputs of a job are made once for all its queries, until its scratch tables are removed.
        key = (spark.sparkContext.applicationId, runtime._RELEASED[0], sf_dir, name)
        if key not in _HELD:
            for old in [k for k in _HELD if k[:2] != key[:2]]:
                del _HELD[old]
            _HELD[key] = jobs.run_job(name, spark, table(spark, sf_dir, "robot_log"), _config(spark, sf_dir))
        return _HELD[key]

    return run


def _job(name: str, part: str, shape=lambda df: df):
    return lambda spark, sf_dir: shape(_outputs(name)(spark, sf_dir)[part])


def _mined_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the answers of question clusters however these were made: none is foreign to the dialogues' pairs, no weight lies
    outside 0 to 1, and each question cluster has an answer."""
    out = _outputs("mining")(spark, sf_dir)
    foreign = out["answers"].join(out["pairs"].select("answer").distinct(), "answer", "left_anti")
    bare = out["clusters"].select("id").distinct().join(out["answers"].select("id").distinct(), "id", "left_anti")
    told = out["answers"].where("not coalesce(weight between 0 and 1, false)").select(F.lit("weight").alias("fault"))
    told = told.unionByName(foreign.select(F.lit("foreign").alias("fault"))).unionByName(bare.select(F.lit("bare").alias("fault")))
    return told.agg(F.count("*").alias("n_faults")).join(F.broadcast(out["answers"].agg((F.count("*") > 0).alias("some"))))  # one row each


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run to its end: hourly counts, written by each batch in full to the shared folder."""
    path = scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "robot_log").schema
    rows = sc.windowed_types(sc.log_stream(spark, f"{sf_dir}/robot_log.parquet", schema, 1000))
    query = rows.writeStream.outputMode("complete").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "n", "cnt0", "cnt11")


def _rounded(*columns: str):
    return lambda df: df.withColumns({c: F.round(c, 7) for c in columns})


def _once(column: str):
    """How often each value of a column comes: an invariant where the other columns depend on a sequential choice."""
    return lambda df: df.groupBy(column).agg(F.count("*").alias("n"))


QUERIES = {
    "job_unanswered_recent": _job("unanswered", "recent"), "job_unanswered_day": _job("unanswered", "day"), "job_unanswered_day_types": _job("unanswered", "day_types"),
    "job_unanswered_periods": _job("unanswered", "periods"), "job_unanswered_map": _job("unanswered", "map"),
    "job_similar_all": _job("similar", "all", _rounded("sim")), "job_similar": _job("similar", "unique", _rounded("sim")), "job_non_centres": _job("similar", "non_centres"),
    "job_knn_samples": _job("knn", "samples", _rounded("sim")), "job_knn": _job("knn", "all", _rounded("score")), "job_knn_one": _job("knn", "one"), "job_knn_count": _job("knn", "count"),
    "job_sessions": _job("sessions", "counts"), "job_session_details": _job("sessions", "details"),
    "job_platforms": _job("semantic", "platforms"), "job_suggestions": _job("semantic", "suggestions", _rounded("rate")), "job_handoffs": _job("semantic", "handoffs"),
    "job_handoff_distances": _job("semantic", "distances"), "job_handoff_weights": _job("semantic", "handoff_weights"), "job_keywords": _job("semantic", "keywords", _rounded("weight")),
    "job_mapping": _job("mapping", "questions"), "job_mapping_ids": _job("mapping", "faq_ids"), "job_segments": _job("segment", "segments"),
    "job_training": _job("training", "lines"), "job_training_ids": _job("training", "faq_ids"),
    "job_import": _job("import", "days", lambda df: df.select("log_id", "cleaned", "tokens", "day")), "job_import_labelled": _job("import", "labelled", lambda df: df.select("log_id", "label")),
    "job_mining_pairs": _job("mining", "pairs"), "job_mining_clusters": _job("mining", "clusters", _once("text")), "job_mining_weights": _job("mining", "weights", lambda df: df.agg(F.sum("size").alias("n_texts"))),
    "job_mining_answers": _mined_answers, "job_clean": _job("clean", "questions"),
    "job_load_details": _job("load", "session_detail"), "job_load_faq": _job("load", "unans_faq", _rounded("score")), "job_load_related": _job("load", "unans_related", _rounded("sim")),
    "job_load_semantic": _job("load", "unans_semantic", lambda df: df.select("question", "today", "answered", "n_hit", "n_30d", "level")), "streamed_counts": streamed,
}


def _month(days: int = 30) -> str:
    """The period's log with simplified questions, to stand in for the whole log."""
    return f"(select * replace ({lq.simplify_sql('question')} as question) from robot_log where {lq._days(days)})"


def _over(name: str, days: int = 30) -> str:
    return lq.SQL[name].replace("from robot_log", f"from {_month(days)} robot_log")


_SEG = "array_to_string(regexp_extract_all(question, '[一-龥]|[a-zA-Z0-9]+'), ' ')"


def _un(days: int, select: str) -> str:
    return f"with {lq._unanswered_sql(days)} {select}"


def _asked(days: int, q: str, seg: str) -> str:
    return _un(days, f"select distinct question as {q}, {_SEG} as {seg} from un")


_SIM = pq.sims_sql(_asked(1, "a", "sa"), _asked(30, "b", "sb"), lq.DOMAIN)
_UNIQUE = f"with {_SIM}, {pq._DOMINATED} select q1, q2, round(sim, 7) as sim from sims where q1 not in (select small from dom)"
_FAQS = f"fa as (select question as q2, arg_max(faq, row(answered, faq)) as faq, bool_or(answered) as answered from ({lq.SQL['question_faq']}) group by 1)"
_NEAR = pq.sims_sql(_asked(1, "a", "sa"), f"with {_FAQS} select q2 as b, {_SEG.replace('question', 'q2')} as sb from fa", lq.DOMAIN, 0.5, True)
_MARKED = f"{_FAQS}, {_NEAR}, mk as (select q1, q2, sim, faq, answered, sim > 0.5 as \"similar\", sim > 0.5 and answered and trim(faq) <> '' as knn_sample from sims join fa using (q2))"
_KNN = f"""{_MARKED}, sa as (select q1 as question, q2 as "similar", sim as similarity, faq from mk where knn_sample), {pq._KN}, {pq._PARSED}, {pq._MERGED}"""
_EMPTY = "(ex is null or lower(ex) = 'null' or trim(ex) = '')"
_KEPT = f"(select * from {_month()} where {_EMPTY} and question in ({_un(1, 'select question from un')}))"
_COUNTED = lq.SQL["type_counts_and_sessions"].replace("from robot_log", f"from {_KEPT} robot_log")
_DETAILS = lq.SQL["session_details"].replace("from robot_log", f"""from (select * from robot_log where {lq._days(30)} and session_id in (select unnest(string_split(concat_ws(',', sessions_1, sessions_0, sessions_11, sessions_u), ',')) from ({_COUNTED}))) robot_log""")
_HANDOFFS = f"select question, a.n_sessions as n_1d, coalesce(b.n_sessions, 0) as n_7d, coalesce(c.n_sessions, 0) as n_30d from ({_over('handoff_counts', 1)}) a left join ({_over('handoff_counts', 7)}) b using (question) left join ({_over('handoff_counts')}) c using (question) where question <> ''"
_SUGGESTED = f"select question, round(rate, 7) as rate, n_hit, n_miss from ({_over('click_rate')}) where question in (select question from {_month(1)} where try_cast(answer_type as integer) = 11)"
_WORD = "|".join(sorted(lq.DOMAIN, key=lambda w: (-len(w), w)))
_ONCE = f"(select * from (select *, row_number() over (partition by {', '.join(jobs.so.FIELDS)} order by loaded_at, log_id) as _r from robot_log) where _r = 1)"
_MINED = pq.dialogues_sql(lq.DOMAIN, lq.IGNORED, 0.7, [])
SQL = {
    "job_unanswered_recent": _un(30, "select question, min(type) as type from un group by 1"),
    "job_unanswered_day": _un(1, "select question, count(*) as n from un group by 1"),
    "job_unanswered_day_types": _un(1, "select question, count(*) filter (type = 0) as cnt0, count(*) filter (type = 11) as cnt11 from un group by 1"),
    "job_unanswered_periods": f"with {lq._unanswered_sql(1)}, b as (select cast(substr(visit_time, 1, 10) as date) as date, ex, {lq.simplify_sql('question')} as question, {lq._type(True)} as type from robot_log where {lq._days(30)}) "
    f"select question, {', '.join(lq._P)} from b where type in (0, 11) and {lq.check_sql('question', 'ex', 2, 40)} and question in (select question from un) group by 1",
    "job_unanswered_map": f"with {lq._unanswered_sql(1)}, c as (select question, count(*) filter (type = 0) as cnt0, count(*) filter (type = 11) as cnt11 from un group by 1) select question, cnt0, cnt11, original from c join (select distinct question, original from un) using (question)",
    "job_similar_all": f"with {_SIM} select q1, q2, round(sim, 7) as sim from sims",
    "job_similar": _UNIQUE,
    "job_non_centres": f"with {_SIM}, {pq._DOMINATED}, {pq._NEAR} {pq._NON_CENTRES}",
    "job_knn_samples": f"with {_MARKED} select q1, q2, round(sim, 7) as sim, faq, answered, \"similar\", knn_sample from mk",
    "job_knn": f"with {_KNN} select question, faq, round(score, 7) as score, rank, size, faq_id from mg",
    "job_knn_one": f"with {_KNN}, ask as ({_un(1, 'select distinct question, original from un')}) select question, faq, faq_id, original from mg join ask using (question) where rank = 1",
    "job_knn_count": f"with {_KNN} select distinct question, size from mg",
    "job_sessions": _COUNTED,
    "job_session_details": _DETAILS,
    "job_platforms": _over("platform_sets"),
    "job_suggestions": _SUGGESTED,
    "job_handoffs": _HANDOFFS,
    "job_handoff_distances": _over("handoff_distances"),
    "job_handoff_weights": _over("handoff_scores"),
    "job_keywords": f"""with {lq._unanswered_sql(1)}, k(word, weight) as (values {', '.join(f"('{w}', {v}::double)" for w, v in WEIGHTS)}),
      q as (select question, unnest(regexp_extract_all(question, '{_WORD}|{pq._INK}')) as word from (select distinct question from un)), a as (select question, coalesce(avg(weight), 0) as weight from q left join k using (word) group by 1)
      select question, round(weight, 7) as weight, case when length(question) = 1 then -1 when weight <= 0.2 and length(question) >= 7 then 0 when weight <= 0.2 then -1 when weight <= 0.5 then 1 else 2 end as level from a""",
    "job_mapping": lq.SQL["question_faq"].replace("from robot_log)", f"from robot_log where {lq._days(30)})"),
    "job_mapping_ids": f"select faq_name, arg_max(faq_id, row(visit_time, log_id)) as latest_id, min(faq_id) as first_id from robot_log where trim(faq_name) <> '' and {lq._days(30)} group by 1",
    "job_segments": f"select distinct faq_name as label, question, {_SEG} as segment from robot_log where faq_name <> '' and question <> ''",
    "job_training": f"""with n as (select faq_name, question, count(*) as n from robot_log where faq_name <> '' and answer_type in ('1', '2') and question <> '' group by 1, 2),
      r as (select *, sum(n) over (partition by faq_name)::bigint as total, row_number() over (partition by faq_name order by n desc, question) as rank from n)
      select '__label__' || replace(faq_name, ' ', '_sp_') || chr(9) || {_SEG} as line from r where rank <= 20 + total // 100""",
    "job_training_ids": "select faq_name, min(faq_id) as first_id from robot_log where trim(faq_name) <> '' group by 1",
    "job_import": f"select log_id, {lq.simplify_sql('question')} as cleaned, regexp_extract_all({lq.simplify_sql('question')}, '[一-龥]|[a-zA-Z0-9]+') as tokens, substr(visit_time, 1, 10) as day from {_ONCE} where visit_time is not null",
    "job_import_labelled": f"""with o as (select log_id, {lq.simplify_sql('question')} as cleaned from {_ONCE}), l as (select {lq.simplify_sql('question')} as cleaned, max(coalesce(sentiment, '')) as label from robot_log group by 1)
      select log_id, label from o join l using (cleaned) where cleaned <> '' union all select log_id, '0' from o where coalesce(cleaned, '') = ''""",
    "job_mining_pairs": _MINED,
    "job_mining_clusters": f"select question as text, 1 as n from ({_MINED}) group by 1",
    "job_mining_answers": f"select 0 as n_faults, count(*) > 0 as some from ({_MINED})",
    "job_mining_weights": f"select count(distinct question) as n_texts from ({_MINED})",
    "job_clean": f"with r as (select distinct question from (select {lq.simplify_sql('question')} as question, ex from robot_log) where {lq.check_sql('question', 'ex', 0, 60)}) select question, row_number() over (order by question) - 1 as number from r",
    "job_load_details": _DETAILS,
    "job_load_faq": f"with {_KNN} select question, faq, faq_id, rank, round(score, 7) as score from mg",
    "job_load_related": _UNIQUE,
    "job_load_semantic": f"select question, p.today, p.answered, n_hit, n_30d, level from ({_over('platform_sets')}) p left join ({_SUGGESTED}) s using (question) left join ({_HANDOFFS}) h using (question) left join ({_over('handoff_scores')}) w using (question)",
    "streamed_counts": """select strftime(try_strptime(visit_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H') as hour, count(*) as n, count(*) filter (answer_type = '0') as cnt0, count(*) filter (answer_type = '11') as cnt11
      from robot_log where try_strptime(visit_time, '%Y-%m-%d %H:%M:%S') is not null group by 1""",
}

"""Queries of similarity, ranking, clustering, mining and loading operators with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions import clean, segment
from chatloom.functions import similarity as sm
from chatloom.functions.strings import value_mock
from chatloom.operators import cluster as cl
from chatloom.operators import mining as mi
from chatloom.operators import pairs as pr
from chatloom.operators import ranking as ra
from chatloom.operators import unanswered as un
from chatloom.plans.log_queries import REF
from chatloom.runtime import materialize, table
from chatloom.sources import tables as so

DOMAIN = ["平板", "路由器", "手表", "净水器", "蓝牙", "怎么办"]
STOP = ["的", "了", "吗", "呢", "啊"]
DAYS = 1
QUERIES, SQL = {}, {}


def _add(name: str, f, sql: str | None = None) -> None:
    QUERIES[name] = f
    if sql:
        SQL[name] = sql


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "robot_log")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "sim_cross").where("yestques is not null and recenques is not null")


# --- Similarity of given pairs ----------------------------------------------------------------------------------------------------------
def _distance_sql(a: str, b: str) -> str:
    """The weighted edit distance as a nested list reduction."""
    chars = lambda x: f"(case when length({x}) = 0 then [] else string_split({x}, '') end)"
    cost = lambda c: f"(case when contains('{sm.FREE}', {c}) then 0 when {c} = '{sm.DEAR}' then 5 else 1 end)"
    swap = "(case when x = y then 0 when (x = 'C' and y = 'G') or (x = 'G' and y = 'C') then 2 else 1 end)"
    row0 = f"list_reduce({chars(b)}, lambda acc, y: list_append(acc, acc[len(acc)] + {cost('y')}), [0])"
    step = f"list_reduce(range(1, length({b}) + 1), lambda acc, j: list_append(acc, least(row[j] + {swap.replace('y', f'{b}[j]')}, row[j + 1] + {cost('x')}, acc[len(acc)] + {cost(f'{b}[j]')})), [row[1] + {cost('x')}])"
    return f"(list_reduce({chars(a)}, lambda row, x: {step}, {row0}))[length({b}) + 1]"


def _sim_sql(a: str, b: str) -> str:
    most = f"greatest(length({a}), length({b}))"
    return f"(case when {most} > 0 then (1::float - (({_distance_sql(a, b)})::double / {most})::float)::float::double end)"


def _factor_sql(a: str, b: str) -> str:
    la, lb = f"length({a})", f"length({b})"
    return f"(case when greatest({la}, {lb}) >= 8 and ({la} > 2 * {lb} or 2 * {la} < {lb}) then 0.5::double else 1::double end)"


def _jaccard_sql(x: str, y: str) -> str:
    common = f"list_sum(list_transform(list_intersect({x}, {y}), lambda v: least(len(list_filter({x}, lambda e: e = v)), len(list_filter({y}, lambda e: e = v)))))"
    common = f"coalesce({common}, 0)"
    return f"({common}::double / (len({x}) + len({y}) - {common}))"


def _domain_sql(x: str, y: str, domain: list[str] = DOMAIN) -> str:
    words = "[" + ", ".join(f"'{w}'" for w in domain) + "]"
    total = lambda a: f"coalesce(list_sum(list_transform({a}, lambda v: case when list_contains({words}, v) then 3 else 1 end)), 0)"
    return f"({total(f'list_intersect({x}, {y})')}::double / {total(f'list_distinct(list_concat({x}, {y}))')})"


_BASE = "s as (select pair_id, yestques as a, recenques as b, string_split(coalesce(yestseg, ''), ' ') as ta, string_split(coalesce(recenseg, ''), ' ') as tb from sim_cross where yestques is not null and recenques is not null)"
_PAIR = f"{_BASE}, d as (select distinct a, b from s)"
_Q = lambda f: lambda s, d: _scored(s, d).select("pair_id", f(F.col("yestques"), F.col("recenques"), F.split(F.coalesce("yestseg", F.lit("")), " "), F.split(F.coalesce("recenseg", F.lit("")), " ")).alias("out"))
_add("edit_distance", _Q(lambda a, b, x, y: sm.edit_distance(a, b)), f"with {_PAIR}, e as (select a, b, ({_distance_sql('a', 'b')})::float as out from d) select pair_id, out from s join e using (a, b)")
_add("edit_distance_expression", _Q(lambda a, b, x, y: sm.edit_distance_expression(a, b)), SQL["edit_distance"])
_add("edit_sim", _Q(lambda a, b, x, y: F.round(sm.edit_sim(a, b), 7)), f"with {_PAIR}, e as (select a, b, round({_sim_sql('a', 'b')}, 7) as out from d) select pair_id, out from s join e using (a, b)")
_add("edit_normalised", _Q(lambda a, b, x, y: F.round(sm.edit_normalised(a, b).cast("double"), 6)), f"with {_PAIR}, e as (select a, b, case when greatest(length(a), length(b)) > 0 then round((({_distance_sql('a', 'b')})::double / greatest(length(a), length(b)))::float::double, 6) end as out from d) select pair_id, out from s join e using (a, b)")
_add("edit_similar", _Q(lambda a, b, x, y: F.round(sm.edit_similar(a, b), 7)), f"with {_PAIR}, e as (select a, b, round({_sim_sql('a', 'b')} * {_factor_sql('a', 'b')}, 7) as out from d) select pair_id, out from s join e using (a, b)")
_RUN = "regexp_extract(replace(X, ' ', ''), '[a-zA-Z0-9_]+')"
_SHORT = f"""r as (select a, b, {_RUN.replace('X', 'a')} as ra, {_RUN.replace('X', 'b')} as rb from d),
  p as (select a, b, case when ra <> '' and ra = rb then replace(a, ra, 'a') else a end as a2, case when ra <> '' and ra = rb then replace(b, rb, 'a') else b end as b2 from r)"""
_add("edit_similar_new", _Q(lambda a, b, x, y: F.round(sm.edit_similar_new(a, b), 7)), f"with {_PAIR}, {_SHORT}, e as (select a, b, round({_sim_sql('a2', 'b2')} * {_factor_sql('a', 'b')}, 7) as out from p) select pair_id, out from s join e using (a, b)")
_add("jaccard_multiset", _Q(lambda a, b, x, y: F.round(sm.jaccard(x, y), 9)), f"with {_BASE} select pair_id, round({_jaccard_sql('ta', 'tb')}, 9) as out from s")
_add("domain_jaccard", _Q(lambda a, b, x, y: F.round(sm.domain_jaccard(x, y, DOMAIN), 9)), f"with {_BASE} select pair_id, round({_domain_sql('ta', 'tb')}, 9) as out from s")
_NB = lambda c: f"replace({c}, ' ', '')"
_BARE = f"""{_BASE}, d as (select distinct {_NB('a')} as a, {_NB('b')} as b from s), {_SHORT},
  e as (select a, b, {_sim_sql('a2', 'b2')} * {_factor_sql('a', 'b')} as s1, {_sim_sql('a', 'b')} * {_factor_sql('a', 'b')} as s0 from p)"""
_COMB = "case when least(s1, s2) < 0.1 and greatest(s1, s2) < 0.75 then least(s1, s2) else greatest(s1, s2) end"
_add("similar_new", _Q(lambda a, b, x, y: F.round(sm.similar_new(a, b, x, y, DOMAIN), 7)), f"with {_BARE}, f as (select pair_id, s1, {_domain_sql('ta', 'tb')} as s2 from s join e on e.a = {_NB('s.a')} and e.b = {_NB('s.b')}) select pair_id, round({_COMB}, 7) as out from f")
_add("similar_plain", _Q(lambda a, b, x, y: F.round(sm.similar_new(a, b, x, y), 7)), f"with {_BARE}, f as (select pair_id, s1, {_jaccard_sql('ta', 'tb')} as s2 from s join e on e.a = {_NB('s.a')} and e.b = {_NB('s.b')}) select pair_id, round({_COMB}, 7) as out from f")
_add("similar_old", _Q(lambda a, b, x, y: F.round(sm.similar_old(a, b, x, y), 7)), f"with {_BARE}, f as (select pair_id, s0, {_jaccard_sql('ta', 'tb')} as s2 from s join e on e.a = {_NB('s.a')} and e.b = {_NB('s.b')}) select pair_id, round(greatest(s0, s2), 7) as out from f")
_add("cluster_distance", _Q(lambda a, b, x, y: F.round(sm.cluster_distance(a, b, x, y), 7)), f"with {_BARE}, f as (select pair_id, s0, {_jaccard_sql('ta', 'tb')} as s2 from s join e on e.a = {_NB('s.a')} and e.b = {_NB('s.b')}) select pair_id, round(1 - greatest(s0, s2), 7) as out from f")
_MODEL = "coalesce(nullif(regexp_extract({0}, '[a-zA-Z0-9]+[-|_][a-zA-Z0-9]+'), ''), 'none')"
_MIXED = "coalesce(nullif(regexp_extract(replace({0}, ' ', ''), '([a-zA-Z]+[0-9]+[a-zA-Z0-9_]*)|([0-9]+[a-zA-Z]+[a-zA-Z0-9_]*)'), ''), 'none')"
_add("pair_filter_keys", lambda s, d: _scored(s, d).select("pair_id", sm.model_number(F.col("yestques")).alias("model"), sm.mixed_token(F.col("yestques")).alias("mixed"), sm.adaptive_threshold(F.col("yestques"), F.col("recenques")).alias("threshold")),
     f"select pair_id, {_MODEL.format('yestques')} as model, {_MIXED.format('yestques')} as mixed, case when length(yestques) < 5 then 0.6::double when 2 * length(yestques) < length(recenques) or length(yestques) > 2 * length(recenques) then 0.8::double else 0.5::double end as threshold from sim_cross where yestques is not null and recenques is not null")


# --- Similar pairs of the log -----------------------------------------------------------------------------------------------------------
def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _log(spark, sf_dir).where("answer_type in ('0', '11') and length(question) > 2 and segment is not null").select("question", F.trim("segment").alias("segment"), un.visit_date().alias("day"))
    one = lambda r: r.groupBy("question").agg(F.min("segment").alias("segment"))
    recent, yesterday = one(rows.where(un.in_days(F.col("day"), REF, 30))), one(rows.where(F.col("day") == REF))
    return yesterday.select(F.col("question").alias("q1"), F.col("segment").alias("seg1")), recent.select(F.col("question").alias("q2"), F.col("segment").alias("seg2"))


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    yesterday, recent = _sides(spark, sf_dir)
    return pr.similar_pairs(pr.candidate_pairs(yesterday, recent, domain=DOMAIN), DOMAIN)


def sims_sql(one: str, two: str, domain: list[str], high: float = 0.6, differ: bool = False) -> str:
    """Tables up to ``sims`` (q1, q2, sim). one: SQL of a, sa; two: of b, sb."""
    keys = lambda q, m, x: f"{_MODEL.format(q)} as {m}, {_MIXED.format(q)} as {x}"
    return f"""
  one as (select *, {keys('a', 'ma', 'xa')} from ({one}) where a is not null and sa is not null), two as (select *, {keys('b', 'mb', 'xb')} from ({two}) where b is not null and sb is not null),
  c as (select *, string_split(sa, ' ') as ta, string_split(sb, ' ') as tb from one, two where ma = mb and (xa = 'none' or xb = 'none' or xa = xb) and contains(sa, ' ') and length(a) > 2{" and trim(a) <> trim(b)" if differ else ""}),
  d as (select distinct {_NB('a')} as a, {_NB('b')} as b from c), {_SHORT},
  e as (select a, b, {_sim_sql('a2', 'b2')} * {_factor_sql('a', 'b')} as s1 from p),
  f as (select c.a as q1, c.b as q2, s1, {_domain_sql('ta', 'tb', domain)} as s2 from c join e on e.a = {_NB('c.a')} and e.b = {_NB('c.b')}),
  g as (select q1, q2, {_COMB} as sim from f),
  sims as (select q1, q2, sim from g where sim > case when length(q1) < 5 then {high} when 2 * length(q1) < length(q2) or length(q1) > 2 * length(q2) then 0.8 else 0.5 end)"""


_LOGGED = "select question, trim(segment) as segment, cast(substr(visit_time, 1, 10) as date) as day from robot_log where answer_type in ('0', '11') and length(question) > 2 and segment is not null"
_SIM = sims_sql(f"select question as a, min(segment) as sa from ({_LOGGED}) where day = date '{REF}' group by 1", f"select question as b, min(segment) as sb from ({_LOGGED}) where day between date '{REF}' - 29 and date '{REF}' group by 1", DOMAIN)
_DOMINATED = "k as (select distinct q1, q2 from sims), n as (select q1, count(*) as n from k group by 1), dom as (select k.q1 as big, k.q2 as small from k join n x on x.q1 = k.q1 join n y on y.q1 = k.q2 where k.q1 <> k.q2 and x.n >= y.n)"
_LINKS = f"{_SIM}, {_DOMINATED}"
_rounded = lambda f: lambda s, d: f(s, d).withColumn("sim", F.round("sim", 7))
_add("similar_pairs", _rounded(similar_pairs), f"with {_SIM} select q1, q2, round(sim, 7) as sim from sims")
_add("drop_dominated", _rounded(lambda s, d: pr.drop_dominated(materialize(similar_pairs(s, d), "pairs"))), f"with {_LINKS} select q1, q2, round(sim, 7) as sim from sims where q1 not in (select small from dom)")
_add("drop_dominated_one", _rounded(lambda s, d: pr.drop_dominated(materialize(similar_pairs(s, d), "pairs"), "one")),
     f"with {_LINKS}, m as (select big, small from dom x where big < small or not exists (select 1 from dom y where y.big = x.small and y.small = x.big)) select q1, q2, round(sim, 7) as sim from sims where q1 not in (select small from m)")
# Of the pairs that are left when dominated questions have gone: with all pairs each question would be the centre of itself.
_NEAR = """near as (select q1, q2 from sims where q1 not in (select small from dom) and q2 in (select a from one))"""
_NON_CENTRES = "select distinct q as question from (select q1 as q from near union all select q2 from near) where q not in (select q1 from near)"
_add("non_centres", lambda s, d: pr.non_centres(pr.drop_dominated(materialize(similar_pairs(s, d), "pairs")), _sides(s, d)[0]), f"with {_LINKS}, {_NEAR} {_NON_CENTRES}")


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _log(spark, sf_dir).where("question is not null").withColumn("ok", F.coalesce(F.col("similarity").try_cast("double") > 0.73, F.lit(False)))
    return rows.groupBy(F.col("question").alias("q2")).agg(F.max(F.coalesce("faq_name", F.lit(""))).alias("faq"), F.bool_or("ok").alias("answered"))


_ANS = "ans as (select question as q2, max(coalesce(faq_name, '')) as faq, bool_or(coalesce(try_cast(similarity as double) > 0.73, false)) as answered from robot_log where question is not null group by 1)"
_KNN = "case when length(q1) > 5 then sim > 0.5 else sim > 0.5 end"
_add("sample_splits", _rounded(lambda s, d: pr.sample_splits(similar_pairs(s, d), _answered(s, d))), f"with {_SIM}, {_ANS} select q1, q2, round(sim, 7) as sim, faq, answered, {_KNN} as similar, ({_KNN}) and answered and trim(faq) <> '' as knn_sample from sims join ans using (q2)")


# --- Ranking ---------------------------------------------------------------------------------------------------------------------------
def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "sim_cross").where("yestques <> '' and recenques <> '' and sim is not null and not isnan(sim)").groupBy(F.col("yestques").alias("question"), F.col("recenques").alias("similar")).agg(F.max("sim").alias("similarity"))
    faqs = _log(spark, sf_dir).where("faq_name <> '' and question is not null").groupBy(F.col("question").alias("similar")).agg(F.max("faq_name").alias("faq"))
    return rows.join(faqs, "similar")


_SAMPLES = """sm as (select yestques as question, recenques as "similar", max(sim) as similarity from sim_cross where yestques <> '' and recenques <> '' and sim is not null and not isnan(sim) group by 1, 2),
  fq as (select question as "similar", max(faq_name) as faq from robot_log where faq_name <> '' and question is not null group by 1), sa as (select * from sm join fq using ("similar"))"""
_KN = """nn as (select *, row_number() over (partition by question order by similarity desc, "similar", faq) as r from sa), vo as (select question, faq, count(*)::double as score from nn where r <= 11 group by 1, 2), kn as (select question, faq, score from (select *, row_number() over (partition by question order by score desc, faq) as r from vo) where r <= 5)"""
_VOTES = f"{_SAMPLES}, {_KN}"
_add("knn_recommend", lambda s, d: ra.knn_recommend(_samples(s, d)), f"with {_VOTES} select * from kn")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as a classifier writes them, made from the log."""
    rows = _log(spark, sf_dir).where("faq_name <> '' and question <> '' and not contains(question, chr(9))")
    best = rows.groupBy("question").agg(F.array_sort(F.collect_set("faq_name")).alias("faqs"))
    return best.select(F.concat(F.col("question"), F.lit("\tx\t"), F.array_join(F.transform("faqs", lambda f, i: F.concat((F.lit(0.5) - i.cast("double") * 0.0009765625).cast("string"), F.lit(","), f)), "|")).alias("line"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    question, made = ra.parse_ranked_line(F.col("line"))
    return _lines(spark, sf_dir).select(question.alias("question"), F.explode(made).alias("p")).select("question", "p.faq", "p.score")


_PARSED = "pa as (select question, list_sort(list_distinct(list(faq_name))) as faqs from robot_log where faq_name <> '' and question <> '' and not contains(question, chr(9)) group by 1), pl as (select question, faqs[i] as faq, 0.5::double - (i - 1) * 0.0009765625::double as score from (select question, faqs, unnest(range(1, len(faqs) + 1)) as i from pa))"
_add("parse_ranked_lines", _parsed, f"with {_PARSED} select question, faq, score from pl")
_add("parse_labels", lambda s, d: _log(s, d).where("faq_name <> ''").select("log_id", F.concat(F.lit("__label__"), F.replace("faq_name", F.lit(" "), F.lit("_sp_")), F.lit(" 0.75 __label__other_sp_name 0.25")).alias("line")).select("log_id", F.explode(ra.parse_labels(F.col("line"))).alias("p")).select("log_id", "p.faq", "p.score"),
     "select log_id, faq_name as faq, 0.75::double as score from robot_log where faq_name <> '' union all select log_id, 'other name', 0.25::double from robot_log where faq_name <> ''")
_MERGED = """al as (select question, faq, sum(score) as score from (select * from kn union all select * from pl) group by 1, 2),
  rk as (select *, row_number() over (partition by question order by score desc, faq) as rank from al), tp as (select *, count(*) over (partition by question) as size from rk where rank <= 5),
  id as (select faq_name as faq, arg_max(faq_id, row(visit_time, log_id)) as latest from robot_log where trim(faq_name) <> '' group by 1),
  mg as (select question, faq, score, rank, size, coalesce(latest, '') as faq_id from tp left join id using (faq) where question not in (select question from tp where trim(question) = trim(faq)))"""
_add("merge_recommendations", lambda s, d: ra.merge_recommendations([ra.knn_recommend(_samples(s, d)), _parsed(s, d).where("score is not null")], un.faq_ids(_log(s, d))), f"with {_VOTES}, {_PARSED}, {_MERGED} select * from mg")


def _united(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a classifier for the sessions as clusters, one for each row."""
    made = F.concat(F.col("session_id"), F.lit("\tx\t__label__"), F.replace("faq_name", F.lit(" "), F.lit("_sp_")), F.lit(" 0.75 __label__other_sp_name 0.25"))
    return ra.unite_labels(_log(spark, sf_dir).where("faq_name <> '' and session_id is not null").select(made.alias("line")), "line", un.faq_ids(_log(spark, sf_dir)))


_add("unite_labels", _united, """with al as (select session_id as cluster, faq, sum(score) as score from (select session_id, faq_name as faq, 0.75::double as score from robot_log where faq_name <> '' and session_id is not null
    union all select session_id, 'other name', 0.25::double from robot_log where faq_name <> '' and session_id is not null) group by 1, 2),
  rk as (select *, row_number() over (partition by cluster order by score desc, faq) as rank from al), tp as (select *, count(*) over (partition by cluster) as size from rk where rank <= 5),
  id as (select faq_name as faq, arg_max(faq_id, row(visit_time, log_id)) as latest from robot_log where trim(faq_name) <> '' group by 1)
  select cluster, faq, score, rank, size, coalesce(latest, '') as faq_id from tp left join id using (faq)""")  # fmt: skip
_add("samples_per_key", lambda s, d: ra.samples_per_key(_log(s, d).where("faq_name <> '' and question is not null"), "faq_name", "question"), """with n as (select faq_name, question, count(*) as n from robot_log where faq_name <> '' and question is not null group by 1, 2),
  r as (select *, sum(n) over (partition by faq_name)::bigint as total, row_number() over (partition by faq_name order by n desc, question) as rank from n) select * from r where rank <= 20 + total // 100""")  # fmt: skip
_add("top_questions", lambda s, d: _log(s, d).where("question is not null").groupBy("question").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "question").limit(20), "select question, count(*) as n from robot_log where question is not null group by 1 order by 2 desc, 1 limit 20")
_add("first_1001", lambda s, d: _log(s, d).orderBy("visit_time", "log_id").limit(1001).select("log_id"), "select log_id from robot_log order by visit_time, log_id limit 1001")
_add("training_lines", lambda s, d: ra.training_lines(_log(s, d).where("faq_name <> '' and answer_type in ('1', '2') and segment is not null"), "faq_name", "segment"), "select '__label__' || replace(faq_name, ' ', '_sp_') || chr(9) || segment as line from robot_log where faq_name <> '' and answer_type in ('1', '2') and segment is not null")
_add("best_of_answer_type", lambda s, d: ra.best_of_cluster(_log(s, d).where("question is not null and platform is not null").select(F.col("platform").alias("group"), F.col("answer_type").alias("cluster"), F.col("question").alias("text")).distinct(), _log(s, d).where("question is not null").groupBy(F.col("question").alias("text")).agg(F.count("*").cast("double").alias("weight"))),
     """with m as (select distinct platform as "group", answer_type as cluster, question as "text" from robot_log where question is not null and platform is not null), w as (select question as "text", count(*)::double as weight from robot_log where question is not null group by 1)
     select "group", cluster, "text", weight from (select *, row_number() over (partition by "group", cluster order by weight desc, "text") as r from m join w using ("text")) where r = 1""")  # fmt: skip
_add("rank_in_group", lambda s, d: ra.ranked_with_size(table(s, d, "sim_cross").where("sim is not null and not isnan(sim)").select("pair_id", "yestques", "sim"), ["yestques"], [F.desc("sim"), F.col("pair_id")], 3), "select *, count(*) over (partition by yestques) as size from (select pair_id, yestques, sim, row_number() over (partition by yestques order by sim desc, pair_id) as rank from sim_cross where sim is not null and not isnan(sim)) where rank <= 3")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by predicted class of all segmented questions, by a regression fitted on them: whether a question was answered. The classes
    depend on the fit; their counts add up to the rows."""
    rows = _log(spark, sf_dir).where("segment is not null").select("segment", (~F.col("answer_type").isin("0", "11")).cast("double").alias("label")).where("label is not null")
    made = mi.hashed_features(rows, "segment", STOP)
    counts = mi.logistic_predict(made, made, "label").groupBy("prediction").agg(F.count("*").alias("n"))
    return counts.agg(F.sum("n").alias("n_rows"), F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("known"))


_add("class_counts", _classified, "select count(*) as n_rows, true as known from robot_log where segment is not null and answer_type is not null")


# --- Clustering and mining -------------------------------------------------------------------------------------------------------------
def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).where("faq_name <> '' and question <> ''").select("faq_name", "question")


def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the clusters of every FAQ's questions whatever the order they were made in: all texts are there, none twice, no cluster
    lacks a core, and no text of a cluster is without a similar one in it."""
    rows = _groups(spark, sf_dir)
    of = materialize(cl.density_clusters(rows, "faq_name", "question", 0.8), "density")
    cores = of.groupBy("group", "cluster").agg(F.max("flag").alias("core"), F.count("*").alias("size"))
    near = of.select("group", "cluster", F.col("text").alias("a")).join(of.select("group", "cluster", F.col("text").alias("b")), ["group", "cluster"]).where("a <> b")
    near = near.where(sm.edit_similar(F.col("a"), F.col("b")) >= 0.8 - 1e-7).groupBy("group", "cluster", "a").agg(F.lit(1).alias("near"))
    told = of.join(cores, ["group", "cluster"]).join(near.withColumnRenamed("a", "text"), ["group", "cluster", "text"], "left")
    return told.groupBy("group").agg(
        F.count_distinct("text").alias("n_texts"), F.count("*").alias("n_rows"), F.count_if(F.col("core") == 0).alias("n_without_core"), F.count_if((F.col("size") > 1) & F.col("near").isNull()).alias("n_apart")
    )


_GROUPED = "(select distinct faq_name as \"group\", question as x from robot_log where faq_name <> '' and question <> '')"
_add("density_clusters", density, f'select "group", count(*) as n_texts, count(*) as n_rows, 0 as n_without_core, 0 as n_apart from {_GROUPED} group by 1')
_FIXED = lambda s, d: _log(s, d).where("question is not null").select(F.col("platform").alias("group"), F.col("answer_type").alias("cluster"), F.col("question").alias("text")).distinct()
_add("cluster_weights", lambda s, d: cl.cluster_weights(_FIXED(s, d), 0.01).withColumn("weight", F.round("weight", 9)), """with n as (select platform as "group", answer_type as cluster, count(distinct question) as size from robot_log where question is not null group by 1, 2)
  select * from (select *, round((size - 1)::double / ((select max(size) from n) - 1), 9) as weight from n) where weight >= 0.01""")  # fmt: skip
_add("cluster_ids", lambda s, d: _FIXED(s, d).select("text", cl.cluster_id("group", "cluster").alias("id")), "select distinct question as text, sha256(concat_ws('|', platform, answer_type)) as id from robot_log where question is not null group by question, platform, answer_type")
_add("rarest_terms", lambda s, d: cl.rarest_terms(_FIXED(s, d).withColumn("tokens", segment.tokenize(F.col("text"), "char")), "tokens"), """with t as (select distinct platform as "group", answer_type as cluster, question as text from robot_log where question is not null),
  w as (select distinct "group", cluster, text, unnest(regexp_extract_all(text, '[一-龥]|[a-zA-Z0-9]+')) as term from t), n as (select *, count(*) over (partition by "group", cluster, term) as n from w where term <> '')
  select "group", cluster, text, arg_max(term, row(-n, term)) as term from n group by 1, 2, 3""")  # fmt: skip
_asked = lambda s, d: _log(s, d).where("question is not null").groupBy("question").agg(F.min("log_id").alias("first")).withColumn("seg", F.array_join(segment.tokenize(F.col("question"), "char"), " "))
# Which cluster a text is in depends on all texts before it; each is in one.
_add("canopy", lambda s, d: cl.canopy(_asked(s, d), "question", "seg", "first", 0.4, 0.3).groupBy("text").agg(F.count("*").alias("n"), F.min("cluster").alias("cluster")).select("text", "n", (F.col("cluster") >= 0).alias("placed")), "select question as text, 1 as n, true as placed from robot_log where question is not null group by 1")
# Each costly character of one text that the other lacks is an edit: such pairs go before the distance is worked out.
_SIMILAR = f"""with g as (select *, list_distinct(string_split(regexp_replace(x, '[{sm.FREE}]', '', 'g'), '')) as cs, length(regexp_replace(x, '[{sm.FREE}]', '', 'g')) as m from {_GROUPED}),
  c as (select l."group", l.x as a, r.x as b from g l join g r on l."group" = r."group" and l.x < r.x and 5 * abs(l.m - r.m) <= greatest(length(l.x), length(r.x))
    where 5 * len(list_filter(l.cs, lambda k: not contains(r.x, k))) <= greatest(length(l.x), length(r.x)) and 5 * len(list_filter(r.cs, lambda k: not contains(l.x, k))) <= greatest(length(l.x), length(r.x))),
  s as (select *, round({_sim_sql('a', 'b')} * {_factor_sql('a', 'b')}, 7) as sim from c), k as (select * from s where sim >= 0.8) select "group", a, b, sim from k union all select "group", b, a, sim from k"""
_add("similar_in_group", lambda s, d: cl.similar_in_group(_groups(s, d), "faq_name", "question", 0.8).withColumn("sim", F.round("sim", 7)), _SIMILAR)


def _kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All distinct segments in their groups: how many there are, and how many of them in a group beyond the asked number."""
    rows = _log(spark, sf_dir).where("segment is not null").groupBy("segment").agg(F.min("log_id").alias("log_id")).withColumn("tokens", F.split("segment", " "))
    made = cl.kmeans_groups(rows, "tokens")
    sizes = made.groupBy("group").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n_texts"), (F.max("group") < F.greatest(F.sum("n") / cl.GROUP_LENGTH, F.lit(1))).alias("inside"))


_add("kmeans_groups", _kmeans, "select count(distinct segment) as n_texts, true as inside from robot_log where segment is not null")
_add("word_vectors", lambda s, d: _vectors(s, d),
     """select term as word from (select unnest(string_split_regex(segment, '[ \t　]+')) as term from robot_log where segment is not null) group by 1 having count(*) >= 5""")  # fmt: skip


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a Word2Vec model over all segments: those that come often enough (the vectors depend on the fit)."""
    model = mi.word_vectors(_log(spark, sf_dir).where("segment is not null").select(F.split("segment", "[ \t　]+").alias("t")), "t")
    return model.getVectors().select("word")


_BASKET = "select pno, vipno, list_distinct(list(trim(prodno))) as items from retail_action where pno <> '' and trim(prodno) <> '' group by 1, 2"


def _itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "retail_action").where("pno <> '' and trim(prodno) <> ''").groupBy("pno", "vipno").agg(F.collect_set(F.trim("prodno")).alias("items"))
    return mi.frequent_itemsets(rows, "items", 0.004)[0].where(F.size("items") == 2).select(F.get("items", F.lit(0)).alias("item_a"), F.get("items", F.lit(1)).alias("item_b"), "freq")


_add("frequent_pairs", _itemsets, f"""with b as ({_BASKET}), u as (select row_number() over () as id, items from b), x as (select id, unnest(items) as i from u)
  select l.i as item_a, r.i as item_b, count(*) as freq from x l join x r on l.id = r.id and l.i < r.i group by 1, 2 having count(*) >= ceil(0.004 * (select count(*) from b))""")  # fmt: skip
_TOK = lambda s, d: _log(s, d).where("segment is not null").select("log_id", F.split("segment", "[ \t　]+").alias("t"))
_VOC = f"""w as (select log_id, unnest(string_split_regex(segment, '[ \t\\x{{3000}}]+')) as term from robot_log where segment is not null), c as (select term, count(*) as n, count(distinct log_id) as df from w where term <> '' group by 1),
  vo as (select term, n, df, ln((select count(*) from robot_log where segment is not null)::double / (df + 1)) as idf from c order by n desc, term limit {mi.VOCABULARY})"""
_add("vocabulary", lambda s, d: mi.vocabulary(_TOK(s, d), "t").withColumn("idf", F.round("idf", 9)), f"with {_VOC} select term, n, df, round(idf, 9) as idf from vo")
_add("tfidf", lambda s, d: mi.tfidf(_TOK(s, d), "log_id", "t", mi.vocabulary(_TOK(s, d), "t")).withColumn("weight", F.round("weight", 9)), f"""with {_VOC}, k as (select log_id, term, count(*)::double as n from w where term <> '' group by 1, 2), l as (select log_id, sum(n) as length from k group by 1)
  select log_id as doc, term, round(k.n / length * coalesce(idf, 3.76::double), 9) as weight from k join l using (log_id) left join vo using (term)""")  # fmt: skip
_add("filtered_tokens", lambda s, d: mi.filtered_tokens(table(s, d, "documents"), "text", ["the", "and", "you"], 1), """with w as (select unnest(string_split_regex(lower(text), '[^a-zA-Z0-9_]+')) as term from documents)
  select term, count(*) as n from w where length(term) >= 2 and not regexp_matches(term, '[0-9]') and term not in ('the', 'and', 'you') group by 1 having count(*) > 1""")  # fmt: skip
_CHARS = "regexp_extract_all(question, '[一-龥]|[a-zA-Z0-9]+')"
_DOCS = lambda s, d: _log(s, d).where("segment is not null").select("log_id", F.filter(F.split("segment", "[ \t　]+"), lambda t: t != "").alias("t"))
_add("term_cosines", lambda s, d: pr.term_cosines(_DOCS(s, d), "log_id", "t").withColumn("cosine", F.round("cosine", 7)), """with t as (select log_id, list_filter(string_split_regex(segment, '[ \t　]+'), lambda v: v <> '') as t from robot_log where segment is not null), w as (select log_id, len(t) as words, unnest(t) as term from t),
  f as (select log_id, term, count(*)::double / nullif(any_value(words) - 1, 0) as tf from w group by 1, 2), k as (select * from f where tf is not null), q as (select term, count(*) as df from k group by 1),
  x as (select log_id, term, tf * log10((select count(*) from t)::double / df) as w from k join q using (term)), y as (select * from x where w > 0), n as (select term, sqrt(sum(w * w)) as norm from y group by 1),
  z as (select l.term as term_a, r.term as term_b, sum(l.w * r.w) as dot from y l join y r on l.log_id = r.log_id and l.term > r.term group by 1, 2)
  select term_a, term_b, round(dot / (na.norm * nb.norm), 7) as cosine from z join n na on na.term = term_a join n nb on nb.term = term_b""")  # fmt: skip
_add("vector_cosine", lambda s, d: table(s, d, "embeddings").join(table(s, d, "embeddings").select((F.col("vec_id") + 1).alias("vec_id"), F.col("embedding").alias("last")), "vec_id").select("vec_id", F.round(pr.vector_cosine(F.col("embedding"), F.col("last")), 6).alias("cosine")),
     "select b.vec_id, round(list_cosine_similarity(b.embedding::double[], a.embedding::double[]), 6) as cosine from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
_add("tokens_char", lambda s, d: _log(s, d).select("log_id", segment.tokenize(F.col("question"), "char").alias("tokens")), f"select log_id, {_CHARS} as tokens from robot_log")
_add("tokens_bigram", lambda s, d: _log(s, d).select("log_id", segment.tokenize(F.col("question"), "cjk_bigram").alias("tokens")), "select log_id, flatten(list_transform(regexp_extract_all(question, '[一-龥]+|[a-zA-Z0-9]+'), lambda r: case when regexp_matches(r, '^[一-龥]{2,}') then list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) else [r] end)) as tokens from robot_log")
_INK = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_MATCH = f"regexp_extract_all(question, '{'|'.join(sorted(DOMAIN, key=lambda w: (-len(w), w)))}|{_INK}')"
_LISTED = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
NATURES = {w: "v" if w == "怎么办" else "n" for w in DOMAIN}
_NATURE = f"case when t = '怎么办' then 'v' when list_contains({_LISTED(DOMAIN)}, t) then 'n' else 'x' end"
_terms = lambda: segment.dictionary_terms(F.col("question"), NATURES, "x")
_add("tokens_dictionary", lambda s, d: _log(s, d).select("log_id", segment.dictionary_tokens(F.col("question"), DOMAIN, STOP).alias("tokens")), f"select log_id, list_filter({_MATCH}, lambda t: not list_contains({_LISTED(STOP)}, t)) as tokens from robot_log")
_add("terms_with_natures", lambda s, d: _log(s, d).select("log_id", segment.with_natures(segment.without(_terms(), STOP)).alias("terms")), f"select log_id, array_to_string(list_transform(list_filter({_MATCH}, lambda t: not list_contains({_LISTED(STOP)}, t)), lambda t: t || '/' || {_NATURE}), ' ') as terms from robot_log")
_add("terms_without_natures", lambda s, d: _log(s, d).select("log_id", segment.words_of(segment.without(_terms(), stop_natures=["x", "v"])).alias("tokens")), f"select log_id, list_filter({_MATCH}, lambda t: list_contains({_LISTED([w for w in DOMAIN if w != '怎么办'])}, t)) as tokens from robot_log")
_plug = lambda f: segment.plugged_terms(F.col("question"), lambda: lambda t: [(w, str(len(w))) for w in t.split(" ") if w != ""]) if f else segment.plugged_tokens(F.col("question"), lambda: lambda t: [w for w in t.split(" ") if w != ""])
_BLANKS = "list_filter(string_split(question, ' '), lambda t: t <> '')"
_add("terms_plugged", lambda s, d: _log(s, d).select("log_id", segment.with_natures(_plug(True), "|").alias("terms")), f"select log_id, array_to_string(list_transform({_BLANKS}, lambda t: t || '/' || length(t)), '|') as terms from robot_log")
_add("tokens_plugged", lambda s, d: _log(s, d).select("log_id", _plug(False).alias("tokens")), f"select log_id, {_BLANKS} as tokens from robot_log")
_FIRST = ["的", "我", "了", "的"]
_add("tokens_first_stop_words", lambda s, d: _log(s, d).select("log_id", segment.only_chinese(segment.drop_first(segment.tokenize(F.col("question"), "char"), _FIRST)).alias("tokens")),
     f"select log_id, list_filter(list_reduce({_LISTED(_FIRST)}, lambda acc, w: case when list_contains(acc, w) then list_concat(acc[:list_position(acc, w) - 1], acc[list_position(acc, w) + 1:]) else acc end, {_CHARS}), lambda t: regexp_matches(t, '[一-龥]')) as tokens from robot_log")
_add("ratios", lambda s, d: table(s, d, "retail_action").select("uid", F.round(mi.double_ratio(F.col("amt"), F.col("qty")), 9).alias("ratio")), "select uid, round(try_cast(amt as double) / nullif(try_cast(qty as double), 0), 9) as ratio from retail_action")
_add("describe_amounts", lambda s, d: mi.describe(table(s, d, "retail_action").withColumn("v", F.col("amt").try_cast("double")), "v", ["site_no"]).select("site_no", *[F.round(c, 6).alias(c) for c in ("mean", "median", "std", "variance", "least", "greatest")]),
     "select site_no, round(coalesce(avg(v), 0), 6) as mean, round(coalesce(median(v), 0), 6) as median, round(stddev_pop(v), 6) as std, round(var_pop(v), 6) as variance, min(v) as least, max(v) as greatest from (select site_no, try_cast(amt as double) as v from retail_action) group by 1")
_add("mode_quantity", lambda s, d: mi.describe(table(s, d, "retail_action").withColumn("v", F.col("qty").try_cast("double")), "v", ["site_no"]).select("site_no", "mode"), """with n as (select site_no, try_cast(qty as double) as v, count(*) as n from retail_action where try_cast(qty as double) is not null group by 1, 2)
  select s.site_no, (select v from n where n.site_no is not distinct from s.site_no order by n desc, v limit 1) as mode from (select distinct site_no from retail_action) s""")  # fmt: skip


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = spark.createDataFrame([(w, 1.0 - i * 0.15) for i, w in enumerate(DOMAIN)], "word string, weight double")
    rows = _log(spark, sf_dir).where("question is not null and segment is not null").groupBy("question").agg(F.split(F.min("segment"), "[ \t　]+").alias("tokens"))
    return mi.keyword_weights(rows, weights)


_add("keyword_weights", lambda s, d: _keywords(s, d).withColumn("weight", F.round("weight", 9)), f"""with k(word, weight) as (values {', '.join(f"('{w}', {1.0 - i * 0.15}::double)" for i, w in enumerate(DOMAIN))}),
  q as (select question, unnest(string_split_regex(min(segment), '[ \t\\x{{3000}}]+')) as word from robot_log where question is not null and segment is not null group by question),
  a as (select question, coalesce(avg(weight), 0) as weight from q left join k using (word) where word <> '' group by 1)
  select question, round(weight, 9) as weight, case when length(question) = 1 then -1 when weight <= 0.2 and length(question) >= 7 then 0 when weight <= 0.2 then -1 when weight <= 0.5 then 1 else 2 end as level from a""")  # fmt: skip


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as dialogues: each row's question by the user, then its answer by the agent."""
    rows = _log(spark, sf_dir).where("question is not null and answer is not null")
    said = rows.select(F.col("session_id").alias("dialogue"), "visit_time", "log_id", F.explode(F.array(F.struct(F.lit("100").alias("speaker"), F.col("question").alias("text")), F.struct(F.lit("200").alias("speaker"), F.col("answer").alias("text")))).alias("s"))
    return said.select("dialogue", "s.speaker", "s.text", (F.row_number().over(W.partitionBy("dialogue").orderBy("visit_time", "log_id", "s.speaker")) - 1).alias("place"))


def _dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = spark.createDataFrame([("转人工",), ("蓝牙失败怎么办",)], "q string")
    return mi.dialogue_pairs(_chat(spark, sf_dir), DOMAIN, gone, answer_ratio=0.5, service_words=["人工"])


_RATIO = r"coalesce(case when length({0}) > 0 then length(regexp_replace({0}, '[^\p{{L}}]|[a-zA-Z]', '', 'g'))::double / length({0}) end >= {1}, false)"
_URL = clean.URL.replace("'", "''")


def dialogues_sql(words: list[str], gone: list[str], ratio: float, service: list[str]) -> str:
    hit = "(" + " or ".join(f"(contains(u, '{w}') and u <> '{w}')" for w in words) + ")"
    said = "".join(f" and not contains(answer, '{w}')" for w in service)
    return f"""with r as (select * from robot_log where question is not null and answer is not null),
  c as (select session_id as dialogue, '100' as speaker, question as text, visit_time, log_id from r union all select session_id, '200', answer, visit_time, log_id from r),
  p as (select *, row_number() over (partition by dialogue order by visit_time, log_id, speaker) - 1 as place, regexp_replace(text, '{_URL}', '', 'g') as u from c),
  q as (select dialogue, text as question, place from p where speaker = '100' and {_RATIO.format('u', 0.3)} and {hit} and length(text) >= 4),
  j as (select q.dialogue, question, a.text as answer, a.place - q.place as gap, a.place as answered from q join p a on a.dialogue = q.dialogue and a.speaker = '200' and a.place > q.place),
  k as (select *, row_number() over (partition by dialogue, question order by gap, answered, answer) as rank from j)
  select distinct * from (select case when length(regexp_replace(question, '{_URL}', '', 'g')) > 200 then substr(regexp_replace(question, '{_URL}', '', 'g'), 1, 199) else regexp_replace(question, '{_URL}', '', 'g') end as question, answer from k
    where rank <= 3 and length(replace(answer, ' ', '')) >= 7 and {_RATIO.format('trim(answer)', ratio)} and not regexp_matches(trim(answer), '(\\?|吗|？|呢|么)$'){said})
  where question not in ({', '.join(f"'{x}'" for x in gone)})"""


_add("dialogue_pairs", _dialogues, dialogues_sql(DOMAIN, ["转人工", "蓝牙失败怎么办"], 0.5, ["人工"]))


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    regions = t("region").select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("id"), F.lit(None).cast("string").alias("parent_id"))
    nations = t("nation").select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("id"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("parent_id"))
    classes = t("nation").select(F.concat(F.lit("c"), F.col("n_nationkey")).alias("id"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("category_id"), F.col("n_name").alias("name"))
    words = t("supplier").select(F.concat(F.lit("c"), F.col("s_nationkey")).alias("class_id"), F.col("s_name").alias("name"))
    return mi.hierarchy_words(regions.unionByName(nations), classes, words, ["r1", "r3"], ["FRANCE"])


_add("hierarchy_words", _tree, """with recursive c as (select 'r' || r_regionkey as id, null::varchar as parent_id from region union all select 'n' || n_nationkey, 'r' || n_regionkey from nation),
  tree as (select id from c where id in ('r1', 'r3') union all select c.id from c join tree on c.parent_id = tree.id)
  select distinct s_name as name from supplier join nation on n_nationkey = s_nationkey where 'n' || n_nationkey in (select id from tree) and n_name <> 'FRANCE' and length(s_name) >= 2""")  # fmt: skip

# --- Loading ---------------------------------------------------------------------------------------------------------------------------
_add("by_day", lambda s, d: so.by_day(table(s, d, "retail_action").where("sldat is not null"), "sldat").groupBy("day").agg(F.count("*").alias("n")), "select substr(sldat, 1, 10) as day, count(*) as n from retail_action where sldat is not null group by 1")
_add("by_day_inclusive", lambda s, d: so.by_day(table(s, d, "retail_action").where("sldat is not null"), "sldat", True).groupBy("day").agg(F.count("*").alias("n")), """select day, count(*) as n from (select substr(sldat, 1, 10) as day from retail_action where sldat is not null
  union all select strftime(cast(substr(sldat, 1, 10) as date) - 1, '%Y-%m-%d') from retail_action where sldat like '% 00:00:00') group by 1""")  # fmt: skip
_KEPT = ["visit_time", "session_id", "user_id", "question", "answer"]
_add("first_of_each", lambda s, d: so.first_of_each(_log(s, d), _KEPT, ["loaded_at", "log_id"]).select("log_id"), f"select log_id from (select log_id, row_number() over (partition by {', '.join(_KEPT)} order by loaded_at, log_id) as r from robot_log) where r = 1")
_add("typed_log", lambda s, d: so.typed_log(_log(s, d)).select("log_id", "answer_type", "similarity", F.date_format("visit_time", "yyyyMMddHHmmss").alias("at")), "select log_id, try_cast(answer_type as integer) as answer_type, try_cast(similarity as double) as similarity, strftime(try_strptime(visit_time, '%Y-%m-%d %H:%M:%S'), '%Y%m%d%H%M%S') as at from robot_log")
_add("merge_labels", lambda s, d: so.merge_labels(_log(s, d).select("log_id", "faq_name"), un.faq_ids(_log(s, d)).select("faq_name", F.col("latest_id").alias("label")), "faq_name", "label").select("log_id", "label"), """select log_id, arg as label from robot_log join (select faq_name, arg_max(faq_id, row(visit_time, log_id)) as arg from robot_log where trim(faq_name) <> '' group by 1) using (faq_name)
  union all select log_id, '0' from robot_log where coalesce(faq_name, '') = ''""")  # fmt: skip
_add("aliases", lambda s, d: so.aliases(_log(s, d).select("log_id", "platform"), s.createDataFrame([("web", "site"), ("ios", "apple"), ("", "none")], "platform string, alias string"), "platform").select("log_id", "alias"), "select log_id, case platform when 'web' then 'site' when 'ios' then 'apple' else '' end as alias from robot_log")
_add("value_mock_bounds", lambda s, d: table(s, d, "retail_action").select("uid", F.col("qty").try_cast("double").alias("q")).where("q is not null").withColumn("v", value_mock(F.col("q"), 10.0, 7)).select("uid", ((F.col("v") >= F.col("q") * 10) & (F.col("v") < F.col("q") * 10 + 10)).alias("ok")), "select uid, true as ok from retail_action where try_cast(qty as double) is not null")

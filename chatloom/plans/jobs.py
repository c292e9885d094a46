"""Jobs: each takes the session, the log and a configuration, and gives its outputs by name as lazy tables.

``run_job`` looks a job up in the registry and, given an output folder, writes every output as Parquet below it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import clean, segment
from chatloom.operators import cluster as cl
from chatloom.operators import mining as mi
from chatloom.operators import pairs as pr
from chatloom.operators import ranking as ra
from chatloom.operators import sessions as se
from chatloom.operators import unanswered as un
from chatloom.runtime import materialize
from chatloom.sources import tables as so


@dataclass(frozen=True)
class JobConfig:
    """Parameters with the reference's defaults; the lists come from files or tables (see sources.tables.read_list).

    classified: other recommenders' scores (question, faq, score). tables: ``labels`` (cleaned, label) for the import; ``categories``,
    ``classes``, ``words`` and ``roots`` (id) of the word base for mining, in place of ``domain``."""

    ref: str = ""
    periods: tuple[int, int, int] = (1, 7, 30)
    excluded_faqs: list[str] = field(default_factory=list)
    excluded_suggestions: list[str] = field(default_factory=list)
    unclear: list[str] = field(default_factory=list)
    ignored: list[str] = field(default_factory=list)
    domain: list[str] = field(default_factory=list)
    keyword_weights: list[tuple[str, float]] = field(default_factory=list)
    classified: list[DataFrame] = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    handoff_faq: str = "转人工服务"
    short: int = 5
    high: float = 0.6
    tokens: str = "char"


def _ignored(log: DataFrame, c: JobConfig) -> DataFrame:
    return log.sparkSession.createDataFrame([(x,) for x in c.ignored], "question string")


def _unanswered(log: DataFrame, c: JobConfig, days: int) -> DataFrame:
    return un.unanswered(log, c.ref, days, c.excluded_faqs, c.unclear, _ignored(log, c), c.domain)


def unanswered_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Recent unanswered questions with their stronger type, the day's counts, the three periods and the question map."""
    day = materialize(_unanswered(log, c, c.periods[0]), "unanswered")
    return {
        "recent": un.strongest_type(_unanswered(log, c, c.periods[2])), "day": un.counts(day, "question"), "day_types": un.type_counts(day),
        "periods": un.period_counts(log, c.ref, c.excluded_faqs, c.unclear, day, c.periods), "map": un.question_map(day),
    }


def similar_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Similar pairs of the day's and the recent unanswered questions, those without dominated ones, and the latter's non-centres."""
    seg = lambda q: F.array_join(segment.tokenize(F.col(q), c.tokens), " ")
    day = _unanswered(log, c, c.periods[0]).select(F.col("question").alias("q1")).distinct().withColumn("seg1", seg("q1"))
    recent = _unanswered(log, c, c.periods[2]).select(F.col("question").alias("q2")).distinct().withColumn("seg2", seg("q2"))
    day = materialize(day, "day")
    pairs = materialize(pr.similar_pairs(pr.candidate_pairs(day, recent, domain=c.domain), c.domain, c.short, c.high), "similar")
    unique = materialize(pr.drop_dominated(pairs), "unique")
    return {"all": pairs, "unique": unique, "non_centres": pr.non_centres(unique, day)}


def knn_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Recommended FAQs by the most similar answered questions and by the classifiers of ``c.classified``, with FAQ ids, the number of each
    question's, and the best one with the day's original questions."""
    seg = lambda q: F.array_join(segment.tokenize(F.col(q), c.tokens), " ")
    faqs = materialize(un.question_faq(log, c.excluded_faqs).groupBy("question").agg(F.max_by("faq", F.struct("answered", "faq")).alias("faq"), F.bool_or("answered").alias("answered")), "faqs")
    asked = materialize(_unanswered(log, c, c.periods[0]).select("question", "original").distinct(), "asked")
    day = asked.select(F.col("question").alias("q1")).distinct().withColumn("seg1", seg("q1"))
    recent = faqs.select(F.col("question").alias("q2")).withColumn("seg2", seg("q2"))
    pairs = pr.similar_pairs(pr.candidate_pairs(day, recent, differ=True, domain=c.domain), c.domain, c.short, 0.5)
    marked = materialize(pr.sample_splits(pairs, faqs.withColumnRenamed("question", "q2")), "knn")
    samples = marked.where("knn_sample").select(F.col("q1").alias("question"), F.col("q2").alias("similar"), F.col("sim").alias("similarity"), "faq")
    all_ = materialize(ra.merge_recommendations([ra.knn_recommend(samples), *c.classified], un.faq_ids(log)), "recommended")
    one = all_.where("rank = 1").select("question", "faq", "faq_id").join(asked, "question")
    return {"samples": marked, "all": all_, "one": one, "count": all_.select("question", "size").distinct()}


def sessions_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Counts and last sessions by type of the period's unanswered questions, and these sessions' details."""
    rows = log.where(un.in_days(un.visit_date(), c.ref, c.periods[2])).withColumn("original", F.col("question")).withColumn("question", clean.simplify(F.col("question")))
    wanted = _unanswered(log, c, c.periods[0]).select("question").distinct()
    kept = rows.where(clean.empty_ex(F.col("ex"))).join(wanted, "question", "left_semi")
    out = materialize(se.type_counts_and_sessions(kept, c.unclear), "sessions")
    ids = out.select(F.explode(F.split(F.concat_ws(",", *[f"sessions_{k}" for k in ("1", "0", "11", "u")]), ",")).alias("session_id")).where("session_id <> ''").distinct()
    return {"counts": out, "details": se.session_details(rows.withColumn("question", F.col("original")).join(ids, "session_id", "left_semi"))}


def semantic_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Platforms, suggestion rates of the day's questions, hand-off counts over the periods, hand-off distances and the questions' weights
    by them, and the day's questions with their keywords' weight and chat level."""
    day = un.visit_date()
    month = log.where(un.in_days(day, c.ref, c.periods[2])).withColumn("question", clean.simplify(F.col("question")))
    suggested = month.where((day == F.lit(c.ref).cast("date")) & (F.col("answer_type").try_cast("int") == 11)).select("question").distinct()
    distances = materialize(se.handoff_distances(month, c.handoff_faq), "distances")
    asked = _unanswered(log, c, c.periods[0]).select("question").distinct().withColumn("tokens", segment.dictionary_tokens(F.col("question"), [w for w, _ in c.keyword_weights]))
    weights = log.sparkSession.createDataFrame(c.keyword_weights, "word string, weight double")
    counts = [se.handoff_counts(month.where(un.in_days(day, c.ref, d)), c.handoff_faq).withColumnRenamed("n_sessions", f"n_{d}d") for d in c.periods]
    merged = counts[0].join(counts[1], "question", "left").join(counts[2], "question", "left").na.fill(0)
    return {
        "platforms": se.platforms(month, c.ref, c.unclear), "suggestions": se.click_rate(se.suggestion_hits(month, c.excluded_suggestions)).join(suggested, "question", "left_semi"),
        "handoffs": merged.where("question <> ''"), "distances": distances, "handoff_weights": se.handoff_scores(distances, c.ref), "keywords": mi.keyword_weights(asked, weights),
    }


def mapping_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    rows = log.where(un.in_days(un.visit_date(), c.ref, c.periods[2]))
    return {"questions": un.question_faq(rows, c.excluded_faqs), "faq_ids": un.faq_ids(rows)}


def segment_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """FAQ name and segmented question of each distinct answered question."""
    rows = log.where("faq_name <> '' and question <> ''").select(F.col("faq_name").alias("label"), "question").distinct()
    return {"segments": rows.withColumn("segment", F.array_join(segment.tokenize(F.col("question"), c.tokens), " "))}


def training_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Training lines from the most frequent questions of each FAQ, and each FAQ's first id."""
    rows = log.where("faq_name <> '' and answer_type in ('1', '2') and question <> ''")
    best = ra.samples_per_key(rows, "faq_name", "question").withColumn("segment", F.array_join(segment.tokenize(F.col("question"), c.tokens), " "))
    return {"lines": ra.training_lines(best, "faq_name", "segment"), "faq_ids": un.faq_ids(log).select("faq_name", "first_id")}


def import_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Log rows once each (the first to be loaded), with the cleaned question and its tokens, by day; with a table of labels also the rows
    with their question's label."""
    keys = [f for f in so.FIELDS if f in log.columns]
    once = so.first_of_each(log, keys, [x for x in ("loaded_at", "log_id") if x in log.columns] or keys[:1])
    cleaned = once.withColumn("cleaned", clean.simplify(F.col("question"))).withColumn("tokens", segment.tokenize(F.col("cleaned"), c.tokens))
    out = {"days": so.by_day(cleaned.where("visit_time is not null"), "visit_time")}
    if "labels" in c.tables:
        out["labelled"] = so.merge_labels(cleaned, c.tables["labels"], "cleaned", "label")
    return out


def words_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Words of the word base below its root categories."""
    t = c.tables
    return {"words": mi.hierarchy_words(t["categories"], t["classes"], t["words"], [r.id for r in t["roots"].collect()], c.excluded_faqs)}


class Outputs(dict):
    """Outputs by name, each made when it is first asked for: one that takes hours isn't made for another that doesn't need it."""

    def __getitem__(self, name: str) -> DataFrame:
        if not isinstance(super().__getitem__(name), DataFrame):
            self[name] = super().__getitem__(name)()
        return super().__getitem__(name)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, self[name]) for name in self]

    def values(self) -> list[DataFrame]:
        return [self[name] for name in self]


def mining_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """Question and answer pairs of the dialogues about the words, the questions' clusters and weights, and the answers of each question
    cluster clustered in turn: the cores of the clusters, with their weights."""
    said = log.where("question is not null and answer is not null").select(
        F.col("session_id").alias("dialogue"), "visit_time", F.explode(F.array(F.struct(F.lit("100").alias("speaker"), F.col("question").alias("text")), F.struct(F.lit("200").alias("speaker"), F.col("answer").alias("text")))).alias("s"), "log_id",
    )
    order = se.W.partitionBy("dialogue").orderBy("visit_time", "log_id", "s.speaker")
    chat = said.select("dialogue", "s.speaker", "s.text", (F.row_number().over(order) - 1).alias("place"))
    about = [r.name for r in words_job(log, c)["words"].collect()] if "words" in c.tables else c.domain  # a dictionary, not data
    pairs = materialize(mi.dialogue_pairs(chat, about, _ignored(log, c)), "qa")

    @cache
    def clusters() -> DataFrame:
        questions = pairs.select("question").distinct().withColumn("tokens", segment.tokenize(F.col("question"), c.tokens))
        return materialize(cl.density_clusters(cl.kmeans_groups(questions, "tokens"), "group", "question"), "clusters")

    def named() -> DataFrame:
        return clusters().withColumn("id", cl.cluster_id("group", "cluster"))

    def answers() -> DataFrame:
        plain = clean.replace_symbol_to_space(clean.remove_head_and_tail_symbol(F.col("answer")))
        answers = materialize(named().select("id", F.col("text").alias("question")).join(pairs, "question").select("id", "answer", plain.alias("plain")).distinct(), "answers")
        of = materialize(cl.density_clusters(answers, "id", "plain"), "answer-clusters")  # read for the weights and for the cores
        weighted = of.join(cl.cluster_weights(of), ["group", "cluster"]).where("flag = 1").select(F.col("group").alias("id"), "cluster", "weight", F.col("text").alias("plain"))
        return weighted.join(answers, ["id", "plain"]).select("id", "cluster", "weight", "answer")

    return Outputs({"pairs": lambda: pairs, "clusters": named, "weights": lambda: cl.cluster_weights(clusters()), "answers": answers})


def clean_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """The distinct cleaned questions that pass the normal check, numbered in their order."""
    rows = un.checked(log.select("question", "ex"), clean.simplify(F.col("question")), lambda q: clean.normal_check(q, F.col("ex"))).select("question").distinct()
    return {"questions": ra.numbered(rows, ["question"], "number")}


def load_job(log: DataFrame, c: JobConfig) -> dict[str, DataFrame]:
    """The tables of results for a database, by their names there; ``load_results`` writes them."""
    semantic, knn = semantic_job(log, c), knn_job(log, c)
    merged = semantic["platforms"].join(semantic["suggestions"], "question", "left").join(semantic["handoffs"], "question", "left").join(semantic["handoff_weights"], "question", "left")
    return {
        "session_detail": sessions_job(log, c)["details"], "unans_faq": knn["all"].select("question", "faq", "faq_id", "rank", "score"),
        "unans_related": similar_job(log, c)["unique"], "unans_semantic": merged.join(semantic["keywords"].withColumnRenamed("weight", "keyword_weight").withColumnRenamed("level", "chat_level"), "question", "left"),
    }


def load_results(tables: dict[str, DataFrame], batch: str, options: dict[str, str], batch_column: str = "batch_id") -> dict[str, int]:
    """Write tables to the database, each in one transaction that replaces the batch's rows; rows deleted and inserted by table."""
    return {name: so.replace_batch(df, name, batch_column, batch, options) for name, df in tables.items()}


JOBS: dict[str, Callable[[DataFrame, JobConfig], dict[str, DataFrame]]] = {
    "unanswered": unanswered_job, "similar": similar_job, "knn": knn_job, "sessions": sessions_job, "semantic": semantic_job, "mapping": mapping_job,
    "segment": segment_job, "training": training_job, "import": import_job, "words": words_job, "mining": mining_job, "clean": clean_job, "load": load_job,
}


def run_job(name: str, spark: SparkSession, log: DataFrame, config: JobConfig, output: str | None = None) -> dict[str, DataFrame]:
    if name not in JOBS:
        raise ValueError(f"no job {name}; there are {', '.join(sorted(JOBS))}")
    out = JOBS[name](log, config)
    if output:
        for part, df in out.items():
            df.write.mode("overwrite").parquet(f"{output}/{name}/{part}")
    return out

"""Mining: itemsets, vocabularies and TF-IDF, word vectors, classifiers, question/answer pairs from dialogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions import clean

VOCABULARY = 100_000
MISSING_IDF = 3.76
# Ends of answers that are questions.
ASKING_ENDS = ["?", "吗", "？", "呢", "么"]
USER, AGENT = "100", "200"


def frequent_itemsets(df: DataFrame, items: str, support: float, confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Itemsets of two or more items (sorted arrays) with their counts, and association rules with confidence and lift."""
    from pyspark.ml.fpm import FPGrowth

    model = FPGrowth(itemsCol=items, minSupport=support, minConfidence=confidence).fit(df.select(F.array_distinct(F.col(items)).alias(items)))
    sets = model.freqItemsets.where(F.size("items") >= 2).select(F.array_sort("items").alias("items"), "freq")
    return sets, model.associationRules


def vocabulary(docs: DataFrame, tokens: str, size: int = VOCABULARY) -> DataFrame:
    """The most frequent terms with counts, document frequencies and idf = ln(N / (df + 1)). Ties: smaller term."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(tokens).alias("t")).select("doc", F.explode("t").alias("term")).where("term <> ''")
    each = rows.groupBy("term", "doc").agg(F.count("*").alias("n"))
    n = each.groupBy("term").agg(F.sum("n").alias("n"), F.count("*").alias("df"))
    total = F.broadcast(docs.agg(F.count("*").alias("total")))
    return n.orderBy(F.desc("n"), "term").limit(size).join(total).select("term", "n", "df", F.log(F.col("total") / (F.col("df") + 1)).alias("idf"))


def tfidf(docs: DataFrame, key: str, tokens: str, vocab: DataFrame, missing: float = MISSING_IDF) -> DataFrame:
    """Weights n / length * idf of each document's terms; a term outside the vocabulary has the idf ``missing``."""
    rows = docs.select(F.col(key).alias("doc"), F.filter(F.col(tokens), lambda t: t != "").alias("t"))
    each = rows.select("doc", F.size("t").alias("length"), F.explode("t").alias("term")).groupBy("doc", "term").agg((F.count("*") / F.first("length")).alias("tf"))
    return each.join(vocab.select("term", "idf"), "term", "left").select("doc", "term", (F.col("tf") * F.coalesce("idf", F.lit(missing))).alias("weight"))


def filtered_tokens(docs: DataFrame, text: str, stop_words: list[str], rare: int = 1) -> DataFrame:
    """Counts of lower-case word tokens without digits, stop words, single characters and terms of ``rare`` or fewer occurrences."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), r"\W+")).alias("term"))
    kept = words.where((F.length("term") >= 2) & ~F.col("term").rlike("[0-9]") & ~F.col("term").isin(stop_words))
    return kept.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") > rare)


def word_vectors(docs: DataFrame, tokens: str, size: int = 50, least: int = 5, seed: int = 1):
    """A Word2Vec model; ``model.findSynonyms(word, n)`` gives the nearest words."""
    from pyspark.ml.feature import Word2Vec

    return Word2Vec(vectorSize=size, minCount=least, seed=seed, inputCol=tokens, outputCol="vector").fit(docs)


def hashed_features(docs: DataFrame, text: str, stop_words: list[str] | None = None, features: int = 1 << 18) -> DataFrame:
    """Tokenizer, stop words, hashed term frequencies and IDF: columns words, kept, tf, features."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer

    stages = [Tokenizer(inputCol=text, outputCol="words"), StopWordsRemover(inputCol="words", outputCol="kept", stopWords=stop_words or []), HashingTF(inputCol="kept", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features")]
    rows = docs.where(F.col(text).isNotNull())
    return Pipeline(stages=stages).fit(rows).transform(rows)


def logistic_predict(train: DataFrame, rows: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Rows with the prediction of a logistic regression, whose class counts ``groupBy('prediction').count()`` gives."""
    from pyspark.ml.classification import LogisticRegression

    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=20).fit(train).transform(rows)


def load_logistic(path: str):
    from pyspark.ml.classification import LogisticRegressionModel

    return LogisticRegressionModel.load(path)


def dialogue_pairs(chat: DataFrame, keywords: list[str], deleted: DataFrame, question_ratio: float = 0.3, answer_ratio: float = 0.7, answers: int = 3, question_length: int = 4, answer_length: int = 7, question_words: list[str] | None = None, service_words: list[str] | None = None) -> DataFrame:
    """Questions of users with the nearest answers of agents in the same dialogue.

    chat: dialogue, speaker, place (order within the dialogue), text. The nearest ``answers`` agent rows after a question are taken first
    and then filtered: long enough, no question, no service phrase, mostly Chinese. Deleted questions are left out, URLs removed, questions
    cut to 199 characters beyond 200. A question's next answers are found by windows over the dialogue, not by pairing its rows."""
    bare = clean.remove_url(F.col("text"))
    hit = F.lit(False)
    for w in keywords:
        hit = hit | (bare.contains(w) & (bare != w))
    asked = clean.chinese_ratio_check(bare, question_ratio) & hit & (F.length("text") >= question_length)
    for_words = question_words or []
    if for_words:
        any_word = F.lit(False)
        for w in for_words:
            any_word = any_word | F.col("text").contains(w)
        asked = asked & any_word
    order = W.partitionBy("dialogue").orderBy("place")
    rows = chat.select("dialogue", "speaker", "place", "text")
    # Number the agents' rows of a dialogue: a question with m before it is answered by numbers m + 1 to m + n.
    before = F.sum((F.col("speaker") == AGENT).cast("int")).over(order)
    placed = rows.withColumn("m", F.coalesce(before, F.lit(0)))
    ask = placed.where((F.col("speaker") == USER) & F.coalesce(asked, F.lit(False))).select("dialogue", F.col("text").alias("question"), F.explode(F.sequence(F.col("m") + 1, F.col("m") + answers)).alias("m"), F.col("place").alias("asked_at"))
    say = placed.where(F.col("speaker") == AGENT).select("dialogue", "m", F.col("text").alias("answer"), F.col("place").alias("answered_at"))
    near = ask.join(say, ["dialogue", "m"]).select("dialogue", "question", "answer", (F.col("answered_at") - F.col("asked_at")).alias("gap"), "answered_at")
    # A question asked again in its dialogue keeps the nearest answers over all its places.
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("dialogue", "question").orderBy("gap", "answered_at", "answer"))).where(F.col("rank") <= answers)
    said = F.trim("answer")
    good = (F.length(F.replace("answer", F.lit(" "), F.lit(""))) >= answer_length) & clean.chinese_ratio_check(said, answer_ratio)
    for end in ASKING_ENDS:
        good = good & ~said.endswith(end)
    for w in (question_words or []) + (service_words or []):
        good = good & ~F.col("answer").contains(w)
    query = clean.remove_url(F.col("question"))
    out = ranked.where(good).select(F.when(F.length(query) > 200, F.substring(query, 1, 199)).otherwise(query).alias("question"), "answer")
    gone = deleted.select(F.col(deleted.columns[0]).alias("question")).distinct()
    return out.join(gone, "question", "left_anti").distinct()


def hierarchy_words(categories: DataFrame, classes: DataFrame, words: DataFrame, roots: list[str], excluded: list[str], least: int = 2) -> DataFrame:
    """Words of all classes below the root categories, without excluded classes and short words.

    categories: id, parent_id; classes: id, category_id, name; words: class_id, name. The closure is one recursive query."""
    spark = categories.sparkSession
    start = ", ".join("'" + r.replace("'", "''") + "'" for r in roots) or "''"
    below = spark.sql(
        f"""with recursive tree as (select id from {{categories}} where id in ({start})
          union all select c.id from {{categories}} c join tree t on c.parent_id = t.id) select distinct id as category_id from tree""",
        categories=categories,
    )
    kept = classes.where(~F.col("name").isin(excluded)).join(below, "category_id", "left_semi").select(F.col("id").alias("class_id"))
    return words.join(kept, "class_id", "left_semi").where(F.length("name") >= least).select("name").distinct()


def keyword_weights(rows: DataFrame, keywords: DataFrame) -> DataFrame:
    """Mean weight of each question's keywords (0 without one) and its chat level. rows: question, tokens; keywords: word, weight."""
    words = rows.select("question", F.explode("tokens").alias("word")).where("word <> ''")
    out = words.join(keywords, "word", "left").groupBy("question").agg(F.coalesce(F.avg("weight"), F.lit(0.0)).alias("weight"))
    return out.withColumn("level", chat_level(F.col("question"), F.col("weight")))


def chat_level(question: Column, weight: Column) -> Column:
    """-1 to 2 by keyword weight and length: 2, one less up to 0.5, two more less up to 0.2; a long text is at least 0, one character -1."""
    level = F.when(weight <= 0.2, -1).when(weight <= 0.5, 1).otherwise(2)
    return F.when(F.length(question) == 1, -1).when((level == -1) & (F.length(question) >= 7), 0).otherwise(level)


def double_ratio(count: Column, total: Column) -> Column:
    """Quotient of two numbers as a double; null where one is null, no number, or the total is 0."""
    return F.try_divide(count.try_cast("double"), total.try_cast("double"))


def describe(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """mean and median (0 without values), mode (ties: smallest), population deviation and variance, least and greatest.

    Values are counted first, spread by key and value, so that a hot key's rows meet in no task; the median is read off the running counts."""
    by = keys or []
    v = F.col(value).cast("double")
    if not by:
        return describe(df.select(v.alias(value), F.lit(0).alias("_all")), value, ["_all"]).drop("_all") if df.head(1) else _empty(df)
    n = df.groupBy(*by, v.alias("_v")).agg(F.count("*").alias("_n"))
    here = W.partitionBy(*by)
    known = F.when(F.col("_v").isNotNull(), F.col("_n"))
    placed = n.withColumn("_before", F.sum(known).over(here.orderBy(F.col("_v").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1))).withColumn("_total", F.sum(known).over(here))
    placed = placed.withColumn("_before", F.coalesce("_before", F.lit(0)))
    holds = lambda place: F.max(F.when(F.col("_v").isNotNull() & (F.col("_before") <= place) & (place < F.col("_before") + F.col("_n")), F.col("_v")))
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")
    mean = F.sum(F.col("_v") * F.col("_n")) / F.sum(known)
    sums = placed.groupBy(*by).agg(
        mean.alias("_mean"), ((holds(low) + holds(high)) / 2).alias("_median"), F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct("_n", (-F.col("_v")).alias("m")))).alias("mode"),
        F.min("_v").alias("least"), F.max("_v").alias("greatest"),
    )
    # The deviations from the mean, in a second pass over the counted values.
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by]
    spread = placed.alias("l").join(sums.alias("r"), same).groupBy(*[F.col(f"r.{k}").alias(k) for k in by]).agg(
        (F.sum((F.col("_v") - F.col("_mean")) * (F.col("_v") - F.col("_mean")) * F.col("_n")) / F.sum(known)).alias("variance")
    )
    out = sums.alias("l").join(spread.alias("r"), same)
    return out.select(
        *[F.col(f"l.{k}") for k in by], F.coalesce("_mean", F.lit(0.0)).alias("mean"), F.coalesce("_median", F.lit(0.0)).alias("median"), "mode",
        F.sqrt("variance").alias("std"), "variance", "least", "greatest",
    )


def _empty(df: DataFrame) -> DataFrame:
    """The statistics of no values: one row."""
    return df.sparkSession.range(1).selectExpr("0D as mean", "0D as median", *[f"cast(null as double) as {c}" for c in ("mode", "std", "variance", "least", "greatest")])

"""Similar question pairs: lossless blocking, similarity, thresholds, removal of dominated questions, centres.

A pair passes only with equal model numbers and with an edit similarity or a token overlap above the least threshold t. By the overlap, the
common tokens weigh more than t of either text's, so that one of the rarest tokens of each, all but a share t of its weight, is common. By the
edit similarity, fewer than (1 - t) * length edits lie between the texts, so that one of as many and one more of the longer text's rarest
characters that cost anything is in the shorter text. Equality joins on these keys lose no pair of the full product.

The keys' rows carry signatures of a fixed width of the texts' characters and tokens (a bit for each, by hash). A bit of one side that the other
lacks stands for a character or token that the other lacks, so that the bounds on lost characters and lost tokens are tested on numbers,
before a pair leaves the join and before any text is fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions import similarity as sm
from chatloom.functions.clean import bind
from chatloom.runtime import materialize


def tokens(c: Column) -> Column:
    return F.split(c, " ")


def signature(items: Column, names: str = "ab") -> Column:
    """64 bits for each of ``names``, a number each; one bit is set for each item of an array."""
    place = F.transform(items, lambda x: F.pmod(F.xxhash64(x), F.lit(64 * len(names))).cast("int"))
    bit = lambda p, low: F.when(p.between(low, low + 63), F.call_function("shiftleft", F.lit(1).cast("long"), p - low)).otherwise(F.lit(0).cast("long"))
    half = lambda places, low: F.aggregate(places, F.lit(0).cast("long"), lambda acc, p: acc.bitwiseOR(bit(p, low)))
    return bind(place, lambda places: F.struct(*[half(places, 64 * k).alias(n) for k, n in enumerate(names)]))


def missing(one: str, two: str, names: str = "ab") -> Column:
    """Bits of signature ``one`` that ``two`` lacks: no more than the items it lacks."""
    return sum(F.bit_count(F.col(f"{one}.{h}").bitwiseAND(F.bitwise_not(F.col(f"{two}.{h}")))) for h in names)


def costly(c: Column) -> Column:
    """The distinct characters of a text whose loss costs an edit at least."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(c, f"[{sm.FREE}]", ""), ""), lambda x: x != ""))


def bag(items: Column) -> Column:
    """Items told apart by their occurrence: the n-th of its kind. Ordered, an item's number is its place after the first of its kind."""
    return bind(F.array_sort(items), lambda ordered: F.transform(ordered, lambda x, i: F.concat(x, F.lit("\0"), (i - F.array_position(ordered, x)).cast("string"))))


def costly_bag(c: Column) -> Column:
    return bag(F.filter(F.split(F.regexp_replace(c, f"[{sm.FREE}]", ""), ""), lambda x: x != ""))


def _described(side: DataFrame, domain: list[str] | None, t: float, bags: bool) -> DataFrame:
    """What the bounds need of each text, in numbers: n characters and ``edits`` that are allowed if it is the longer one, signatures of
    characters and tokens, the weight of tokens that may be lost, and m characters (with ``bags``) that cost something."""
    words = tokens(F.col("seg"))
    none = F.array().cast("array<string>")
    bare = F.regexp_replace("q", f"[{sm.FREE}]", "")
    grams = bind(bare, lambda b: F.when(F.length(b) >= 2, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(b) - 1), lambda i: F.substring(b, i, F.lit(2))))).otherwise(none)) if bags else none
    kinds = F.array_distinct(words)
    weight = F.size(words) if domain is None else F.aggregate(kinds, F.lit(0), lambda acc, x: acc + F.when(x.isin(domain or [""]), 3).otherwise(1))
    n = F.length("q")
    edits = F.floor((1 - t) * n + F.lit(1e-6)).cast("int")
    return side.select("id", "model", n.alias("n"), edits.alias("edits"), costly(F.col("q")).alias("chars"), grams.alias("grams"), words.alias("words"), kinds.alias("kinds"), signature((costly_bag if bags else costly)(F.col("q")), _bits(bags)).alias("cs"), signature(bag(words) if bags else kinds, _bits(bags)).alias("ts"), (F.size(costly_bag(F.col("q"))) if bags else F.lit(0)).alias("m"), ((1 - t) * weight + 1e-9).alias("spare"), weight.alias("weight"))


def _bits(bags: bool) -> str:
    """Whole texts are told apart by longer signatures: short ones leave of long texts too many pairs."""
    return "abcdefgh" if bags else "ab"


_NUMBERS = ["n", "edits", "cs", "ts", "spare", "m"]


def _often(each: DataFrame, seen: DataFrame) -> DataFrame:
    """Keys of each text with their frequency in ``seen``, to be ordered rarest first."""
    n = seen.groupBy("key").agg(F.count("*").alias("often"))
    return each.join(n, "key", "left").withColumn("often", F.coalesce("often", F.lit(0)))


def _block(one: DataFrame, two: DataFrame, domain: list[str] | None, t: float, bags: bool = False) -> DataFrame:
    """Pairs of numbers (i of ``one``, j of ``two``) that share a key and that the signatures leave. one, two: id, model, q, seg (q without
    blanks). With ``bags`` repeated characters and tokens count each (for similarities of the texts as they are and multisets of tokens), and the
    two tables are one: each pair comes once, i < j."""
    order = W.partitionBy("id").orderBy("often", "key")
    one, two = (_described(side, domain, t, bags) for side in (one, two))
    words = lambda side: side.select("id", "model", *_NUMBERS, "weight", "words", F.explode("kinds").alias("key"))
    # An edit costs a text two of its pairs of neighbouring characters at most: where it has enough of them (and its characters count as
    # they are), its rarest pairs are its keys, which come in far fewer texts than characters.
    by_grams = F.size("grams") > 2 * F.col("edits")
    rare = lambda side: side.select("id", "model", *_NUMBERS, F.when(by_grams, 2 * F.col("edits") + 1).otherwise(F.col("edits") + 1).alias("take"), F.explode(F.when(by_grams, F.col("grams")).otherwise(F.col("chars"))).alias("key"))
    chars = lambda side: side.select("id", "model", *_NUMBERS, F.explode(F.concat("chars", "grams")).alias("key"))

    def token_prefix(side: DataFrame, seen: DataFrame) -> DataFrame:
        w = F.size(F.filter("words", lambda x: x == F.col("key"))) if domain is None else F.when(F.col("key").isin(domain or [""]), 3).otherwise(1)
        rows = _often(words(side).withColumn("w", w).drop("words"), seen).withColumn("before", F.coalesce(F.sum("w").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        return rows.where(F.col("before") <= (1 - t) * F.col("weight") + 1e-9).select("id", "model", "key", *_NUMBERS)

    any_key = lambda side: side.select("id", "model", F.lit("any").alias("key"), *_NUMBERS)

    def char_prefix(side: DataFrame, seen: DataFrame) -> DataFrame:
        rows = _often(rare(side), seen).withColumn("place", F.row_number().over(order))
        return rows.where("place <= take").select("id", "model", "key", *_NUMBERS).unionByName(any_key(side.where((F.size("chars") <= F.col("edits")) & ~by_grams)))

    def all_chars(side: DataFrame) -> DataFrame:
        return chars(side).select("id", "model", "key", *_NUMBERS).unionByName(any_key(side))

    named = lambda d, s: d.select("model", "key", F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in _NUMBERS])
    bits = _bits(bags)
    lost = lambda c: F.greatest(missing(f"{c}_i", f"{c}_j", bits), missing(f"{c}_j", f"{c}_i", bits))
    near = (lost("cs") <= F.greatest("edits_i", "edits_j")) & (F.abs(F.col("m_i") - F.col("m_j")) <= F.greatest("edits_i", "edits_j"))
    alike = (missing("ts_i", "ts_j", bits) <= F.col("spare_i")) & (missing("ts_j", "ts_i", bits) <= F.col("spare_j"))
    met = lambda x, y, keep: named(x, "i").join(named(y, "j"), ["model", "key"]).where(keep).select("i", "j")
    seen_words, seen_chars = words(two).select("key"), chars(two).select("key")
    by_token = met(token_prefix(one, seen_words), token_prefix(two, seen_words), alike)
    left_long = met(char_prefix(one, seen_chars), all_chars(two), (F.col("n_i") >= F.col("n_j")) & near)
    if bags:  # a table with itself: each pair once, smaller number first
        both = by_token.where("i < j").unionByName(left_long.where("i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")))
        return both.distinct()
    right_long = met(all_chars(one), char_prefix(two, seen_chars), (F.col("n_j") >= F.col("n_i")) & near)
    return by_token.unionByName(left_long).unionByName(right_long).distinct()


def candidate_pairs(yesterday: DataFrame, recent: DataFrame, differ: bool = False, domain: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """Pairs that pass the filter before similarity and may exceed ``least``: q1, seg1, q2, seg2.

    yesterday: q1, seg1; recent: q2, seg2. Texts are at least three characters and of two tokens on the left; model numbers are equal, and so
    are mixed letter-digit tokens where both have one. ``domain`` must be that of the similarity."""
    side = lambda d, q, seg: d.select(F.col(q).alias("text"), F.col(seg).alias("seg")).where("text is not null and seg is not null").distinct().select("*", sm.model_number(F.col("text")).alias("model"), sm.mixed_token(F.col("text")).alias("mixed"), F.replace("text", F.lit(" "), F.lit("")).alias("q"), F.monotonically_increasing_id().alias("id"))
    one = materialize(side(yesterday.where((F.length("q1") > 2) & F.col("seg1").contains(" ")), "q1", "seg1"), "pairs-left")
    two = materialize(side(recent, "q2", "seg2"), "pairs-right")
    met = _block(one, two, domain, least)
    left = one.select(F.col("id").alias("i"), F.col("text").alias("q1"), F.col("seg").alias("seg1"), F.col("mixed").alias("mixed1"))
    right = two.select(F.col("id").alias("j"), F.col("text").alias("q2"), F.col("seg").alias("seg2"), F.col("mixed").alias("mixed2"))
    agree = (F.col("mixed1") == "none") | (F.col("mixed2") == "none") | (F.col("mixed1") == F.col("mixed2"))
    pairs = met.join(left, "i").join(right, "j").where(agree)
    if differ:
        pairs = pairs.where(F.trim("q1") != F.trim("q2"))
    # The characters and tokens themselves, now that both texts are at hand.
    a, b = (F.replace(q, F.lit(" "), F.lit("")) for q in ("q1", "q2"))
    edits = F.floor((1 - least) * F.greatest(F.length(a), F.length(b)) + F.lit(1e-6))
    lost = F.greatest(F.size(F.array_except(costly(a), costly(b))), F.size(F.array_except(costly(b), costly(a))))
    overlap = sm.jaccard(tokens(F.col("seg1")), tokens(F.col("seg2"))) if domain is None else sm.domain_jaccard(tokens(F.col("seg1")), tokens(F.col("seg2")), domain)
    return pairs.where((lost <= edits) | (overlap > least)).select("q1", "seg1", "q2", "seg2")


def spread(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def similar_pairs(pairs: DataFrame, domain: list[str] | None = None, short: int = 5, high: float = 0.6) -> DataFrame:
    """Pairs whose similarity exceeds the threshold for their lengths."""
    sim = sm.similar_new(F.col("q1"), F.col("q2"), tokens(F.col("seg1")), tokens(F.col("seg2")), domain)
    # Few bytes but much work in each row: spread evenly, or adaptive execution leaves it to a few tasks.
    scored = spread(pairs).withColumn("sim", sim)
    return scored.where(F.col("sim").isNotNull() & (F.col("sim") > sm.adaptive_threshold(F.col("q1"), F.col("q2"), short, high))).select("q1", "q2", "sim")


def drop_dominated(pairs: DataFrame, mode: str = "both") -> DataFrame:
    """Pairs without the questions that another one dominates: q is dominated by q' if q' has it among its similar ones and at least as many of
    them. mode 'both': of two that dominate each other both go; 'one': the smaller string stays."""
    links = pairs.select("q1", "q2").distinct()
    n = links.groupBy("q1").agg(F.count("*").alias("n"))
    other = n.select(F.col("q1").alias("q2"), F.col("n").alias("n2"))
    held = links.where("q1 <> q2").join(n, "q1").join(other, "q2").where("n >= n2")  # q1 dominates q2
    if mode == "one":
        back = held.select(F.col("q1").alias("q2"), F.col("q2").alias("q1"), F.lit(True).alias("mutual"))
        held = held.join(back, ["q1", "q2"], "left").where("mutual is null or q1 < q2")
    return pairs.join(held.select(F.col("q2").alias("q1")).distinct(), "q1", "left_anti")


def non_centres(pairs: DataFrame, yesterday: DataFrame) -> DataFrame:
    """Yesterday's questions that occur in pairs but are no centre (left side of a pair with one of yesterday's)."""
    near = pairs.select("q1", "q2").join(yesterday.select(F.col("q1").alias("q2")).distinct(), "q2", "left_semi")
    every = near.select(F.col("q1").alias("question")).unionByName(near.select(F.col("q2").alias("question"))).distinct()
    return every.join(near.select(F.col("q1").alias("question")).distinct(), "question", "left_anti")


def sample_splits(pairs: DataFrame, answered: DataFrame, short: int = 5, similarity: float = 0.5, high: float = 0.5) -> DataFrame:
    """Pairs with the marks of the three outputs: similar, and knn_sample (answered by an FAQ). answered: q2, faq, answered."""
    enough = F.when(F.length("q1") > short, F.col("sim") > similarity).otherwise(F.col("sim") > high)
    joined = pairs.join(answered, "q2", "left")
    return joined.withColumn("similar", enough).withColumn("knn_sample", enough & F.coalesce(F.col("answered") & (F.trim("faq") != ""), F.lit(False)))


def term_cosines(docs: DataFrame, key: str, terms: str) -> DataFrame:
    """Cosines above 0 of all pairs of terms over the documents, with tf = n / (words - 1) and idf = log10(N / df)."""
    rows = docs.select(F.col(key).alias("doc"), F.col(terms).alias("terms"))
    n = rows.agg(F.count("*").alias("total"))
    words = rows.select("doc", F.size("terms").alias("words"), F.explode("terms").alias("term")).where("term <> ''")
    tf = words.groupBy("doc", "term").agg((F.count("*") / F.nullif(F.first("words") - 1, F.lit(0))).alias("tf")).where("tf is not null")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weights = tf.join(df, "term").join(F.broadcast(n)).select("doc", "term", (F.col("tf") * F.log10(F.col("total") / F.col("df"))).alias("w")).where("w > 0")
    norm = weights.groupBy("term").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    a, b = weights.select("doc", F.col("term").alias("term_a"), F.col("w").alias("wa")), weights.select("doc", F.col("term").alias("term_b"), F.col("w").alias("wb"))
    dots = a.join(b, "doc").where("term_a > term_b").groupBy("term_a", "term_b").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    na, nb = norm.select(F.col("term").alias("term_a"), F.col("norm").alias("na")), norm.select(F.col("term").alias("term_b"), F.col("norm").alias("nb"))
    return dots.join(na, "term_a").join(nb, "term_b").select("term_a", "term_b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("cosine")).where("cosine > 0")


def vector_cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; null where one is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)

import math
import random

import pytest
from pyspark.sql import functions as F

from chatloom.functions import clean, segment, strings
from chatloom.functions import similarity as sm
from chatloom.operators import pairs as pr


def plain(a, b):
    cost = lambda c: 0 if c in "的 最和" else 5 if c == "不" else 1
    row = [0]
    for y in b:
        row.append(row[-1] + cost(y))
    for x in a:
        new = [row[0] + cost(x)]
        for j, y in enumerate(b):
            swap = 0 if x == y else 2 if {x, y} == {"C", "G"} else 1
            new.append(min(row[j] + swap, row[j + 1] + cost(x), new[-1] + cost(y)))
        row = new
    return row[-1]


KNOWN = [("kitten", "sitting", 3), ("a b", "ab", 0), ("我不去", "我去", 2), ("C", "G", 2), ("的最", "最好", 1), ("", "ab", 2), ("abc", "", 3), ("", "的", 0), ("", "", 0)]


def test_edit_distance(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("的 最和不CGab中") for _ in range(rnd.randint(0, 9)))
    pairs = [(a, b) for a, b, _ in KNOWN] + [(word(), word()) for _ in range(300)] + [("x" * 400, "y" * 300), ("😀a", "a")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)] + [(-1, None, "a")], "i int, a string, b string")
    got = df.select("i", sm.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert {r.i: r.d for r in got} == {-1: None} | {i: plain(a, b) for i, (a, b) in enumerate(pairs)}
    few = df.where("i between 0 and 60")
    assert all(r.x == r.y for r in few.select(sm.edit_distance(F.col("a"), F.col("b")).alias("x"), sm.edit_distance_expression(F.col("a"), F.col("b")).alias("y")).collect())
    assert [d for *_, d in KNOWN] == [plain(a, b) for a, b, _ in KNOWN]


def test_similarities(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    lit = F.lit
    assert one(sm.edit_sim(lit("abc"), lit("abd"))) == pytest.approx(0.6666666269302368, abs=1e-12)
    assert one(sm.edit_sim(lit(""), lit(""))) is None
    assert one(sm.edit_similar(lit("a" * 20), lit("a" * 9))) == pytest.approx((1 - 11 / 20) / 2, abs=1e-6)
    words = lambda *w: F.array(*map(F.lit, w))
    assert one(sm.jaccard(words("a", "a", "b", "a"), words("a", "a", "c"))) == pytest.approx(2 / 5)
    assert one(sm.domain_jaccard(words("a", "b"), words("a", "c"), ["a"])) == pytest.approx(3 / 5)
    assert one(sm.combined(lit(0.05), lit(0.7))) == 0.05 and one(sm.combined(lit(0.05), lit(0.8))) == 0.8
    assert one(sm.model_number(lit("型号AB-12和C_3"))) == "AB-12" and one(sm.model_number(lit("无"))) == "none"


def test_blocking_loses_no_pair(spark):
    rnd = random.Random(3)
    words = ["怎么", "安装", "手机", "a1", "的", "和", "不", "M-1", "x_2", "最", "打不开", "了"]
    texts = sorted({"".join(t) if k % 3 else " ".join(t) for k in range(90) for t in [[rnd.choice(words) for _ in range(rnd.randint(1, 6))]]} | {"的的的", "的的的的 a", "abc", "abd", "的最和", "和最的"})
    seg = {t: " ".join(x for x in t.replace(" ", "")) if rnd.random() < 0.7 else t.replace(" ", "") + " z" + str(i) for i, t in enumerate(texts)}
    one = spark.createDataFrame([(t, seg[t]) for t in texts], "q1 string, seg1 string")
    two = spark.createDataFrame([(t, seg[t]) for t in texts], "q2 string, seg2 string")
    got = {(r.q1, r.q2) for r in pr.similar_pairs(pr.candidate_pairs(one, two, domain=["怎么"]), ["怎么"]).collect()}
    full = one.where((F.length("q1") > 2) & F.col("seg1").contains(" ")).crossJoin(two)
    full = full.where(sm.model_number(F.col("q1")) == sm.model_number(F.col("q2")))
    m1, m2 = sm.mixed_token(F.col("q1")), sm.mixed_token(F.col("q2"))
    full = full.where((m1 == "none") | (m2 == "none") | (m1 == m2)).select("q1", "seg1", "q2", "seg2")
    assert got == {(r.q1, r.q2) for r in pr.similar_pairs(full, ["怎么"]).collect()} and len(got) > 20


def test_dominated_and_centres(spark):
    pairs = spark.createDataFrame([("a", "b", 0.9), ("b", "a", 0.9), ("a", "a", 1.0), ("b", "b", 1.0), ("c", "a", 0.8), ("d", "d", 1.0)], "q1 string, q2 string, sim double")
    left = lambda mode: {r.q1 for r in pr.drop_dominated(pairs, mode).collect()}
    assert left("both") == {"c", "d"} and left("one") == {"a", "c", "d"}
    yesterday = spark.createDataFrame([("a",), ("b",), ("c",)], "q1 string")
    assert {r.question for r in pr.non_centres(spark.createDataFrame([("a", "b", 1.0), ("c", "c", 1.0)], "q1 string, q2 string, sim double"), yesterday).collect()} == {"b"}


def test_text_rules(spark):
    one = lambda f, x: spark.createDataFrame([(x,)], "x string").select(f(F.col("x"))).first()[0]
    assert one(clean.remove_face, "[悲伤][悲伤]好[微笑]") == "好[微笑]"
    assert one(clean.remove_qq, "@昵称(123456)在吗") == "在吗"
    assert one(clean.simplify, "请您一次只问一个问题，你好。 Ａb") == "你好 ａb"
    assert one(clean.ignore_simplify, "。。Hi 你好!") == "hi你好"
    assert one(lambda c: clean.only_duplicate_char_check(c, 3), "哈哈哈") is False
    assert one(lambda c: clean.not_cont_duplicate_char_check(c, 3), "啊哈哈哈") is False
    assert one(clean.keep_question, "12") is True and one(lambda c: clean.keep_question(c, "strict"), "12") is False
    assert one(clean.chinese_ratio, "aé中1") == 0.5 and one(clean.chinese_ratio, "") is None
    assert one(strings.is_decimal, "a5") is True and one(lambda c: strings.is_decimal(c, "strict"), "a5") is False
    assert one(strings.get_date, "nonsense") == "1970-01-01" and one(lambda c: strings.java_split(c, r"\|"), "a||b||") == ["a", "", "b"]
    assert one(strings.is_english_sentence, "hello world") is False and one(strings.remove_brackets, "(a)") == "a"
    assert one(lambda c: segment.tokenize(c, "cjk_bigram"), "怎么用ab1好") == ["怎么", "么用", "ab1", "好"]
    assert one(lambda c: segment.dictionary_tokens(c, ["路由器", "怎么"], ["的"]), "路由器的怎么 x") == ["路由器", "怎么", "x"]
    assert one(lambda c: segment.plugged_tokens(c, lambda: lambda t: t.split("-")), "a-b") == ["a", "b"]
    for f in (clean.simplify, clean.remove_face, strings.esc, clean.is_voice):
        assert one(f, None) is None
    assert math.isclose(spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>").select(pr.vector_cosine(F.col("a"), F.col("b"))).first()[0], 2**-0.5)

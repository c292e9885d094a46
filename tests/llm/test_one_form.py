import unicodedata

from chatloom.llm import one_form as of


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, q string")
    return [r.f for r in of.one_form(df, "q", "f").orderBy("id").collect()]


def test_reads_the_same(spark):
    same = [("ＡＢＣ１２？", "ABC12?"), ("Café", "Café"), ("a​b﻿­c⁠", "abc"), ("a b　c d\te\nf", "a b c d e f"), ("САFЕ", "CAFE"), ("ΑΒ", "AB"),
            ("ё", "ë"), ("ё", "ë"), ("⼈⽤", "人用"), ("ﬁn…", "fin..."), ("x\u0000y", "xy"), ("㍿", "株式会社"), ("it''s", "it''s"), ("ｶﾞ", "ガ"), ("Å", "Å"), ("1️⃣", "1⃣")]
    got = forms(spark, [x for p in same for x in p])
    assert [got[i] == got[i + 1] for i in range(0, len(got), 2)] == [True] * len(same)
    assert got[1] == "ABC12?"


def test_differences_one_sees_are_kept(spark):
    different = ["Cafe", "Café", "cafe", "CAFE", "O", "0", "l", "1", "a b", "a  b", "ab", "。", ".", "，"]
    assert len(set(forms(spark, different))) == len(different)


def test_look_alikes(spark):
    pairs = of.LOOK_ALIKES.split()
    assert len({p[0] for p in pairs}) == len(pairs) and all(len(p) == 2 and p[1].isascii() and not p[0].isascii() for p in pairs)
    assert forms(spark, ["".join(p[0] for p in pairs)]) == ["".join(p[1] for p in pairs)]
    seen = "αβγδεικνρσυжиля中ーａ"  # letters whose shape is their own, and one that is not
    assert forms(spark, [seen]) == [seen[:-1] + "a"]


def test_edges(spark):
    long = "ＡА​" * 200_000
    assert forms(spark, [None, "", "​﻿", long, "x"]) == [None, "", "", "AA" * 200_000, "x"]
    empty = spark.createDataFrame([], "id int, q string")
    assert of.one_form(empty, "q").collect() == []


def test_matches_compatibility_normalization():
    table = of.one_form_table()
    for c in "ﷺ①Ⅳ㎏ﬀªºſ℡㊙":
        assert table[c] == unicodedata.normalize("NFKC", c)


def test_join(spark):
    rows = spark.createDataFrame([(1, "ＡＢ", "s"), (2, "AB", "s"), (3, "AB​", "s"), (3, "AB​", "s"), (4, None, "s"), (5, "ab", "s")], "log_id long, question string, form string")
    std = spark.createDataFrame([(7, "AB"), (8, None), (9, "ВA")], "std_id long, standard string")
    assert sorted((r.log_id, r.std_id) for r in of.read_the_same(rows, "question", std, "standard").collect()) == [(1, 7), (3, 7), (3, 7)]
    assert of.read_the_same(rows.limit(0), "question", std, "standard").collect() == []
    assert of.read_the_same(rows, "question", std.limit(0), "standard").collect() == []

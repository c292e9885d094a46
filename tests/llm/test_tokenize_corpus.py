import random

import pytest

from chatloom.llm import tokenize_corpus as tc

tokenizers = pytest.importorskip("tokenizers")
JSON = tc.TOKENIZER.replace(".tiktoken", ".json")


@pytest.fixture(scope="module")
def enc():
    with open(tc.TOKENIZER, "rb") as f:
        return tc.encoder(f.read())


@pytest.fixture(scope="module")
def other():
    t = tokenizers.Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


TEXTS = [
    "", " ", "  \n\n a", "don't we'LL", "<|endoftext|>", "净水器的指纹。[图片]", "a" * 5000, "ab" * 3000, "😀" * 2000, " " * 4000 + "x", "1234567890" * 700,
    "é" * 3001, "中文" * 2500 + " end", "!?" * 2600 + "\n", "x\x00y\x1cz​", "".join(chr(random.Random(1).randrange(97, 123)) for _ in range(1)) * 1025,
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_other_library(enc, other, text):
    assert tc.encode_text(enc, text) == other(text)


def test_halves_joined_equal_the_whole(enc):
    rnd = random.Random(7)
    for alphabet in ("ab", "aaab", "etaoin", "中文字的", "01"):
        text = "".join(rnd.choice(alphabet) for _ in range(6000))
        assert tc.encode_piece(enc, text) == enc._encode_single_piece(text.encode())


def test_blocks_keep_the_ids(enc):
    rnd = random.Random(3)
    text = "".join(rnd.choice(["word ", "it's ", "12a", "，", "中文", "  ", "\n", "x" * 30, "é"]) for _ in range(4000))
    cut = tc.blocks(text, 700)
    assert len(cut) > 5 and "".join(b for b, _ in cut) == text and {kind for _, kind in cut} == {tc.WHOLE}
    assert [i for b, _ in cut for i in enc.encode_ordinary(b)] == enc.encode_ordinary(text)


def from_blocks(enc, text, size):
    cut, out, parts = tc.blocks(text, size), [], []
    assert "".join(b for b, _ in cut) == text and all(b for b, _ in cut)
    for b, kind in cut:
        if kind == tc.WHOLE:
            out += tc.encode_text(enc, b)
            continue
        parts.append(tc.encode_piece(enc, b))
        if kind == tc.LAST:
            out += tc.join_parts(enc, parts)
            parts = []
    assert not parts
    return out, cut


@pytest.mark.parametrize("seed", range(8))
def test_unsplit_runs_in_parts(enc, other, seed):
    rnd = random.Random(seed)
    for run in ("a" * 3000, "abc" * 900, " " * 2500, "\n" * 900, " \n" * 700, "!?" * 1100, "é" * 2001, "中" * 1800, "7" * 1500, "😀" * 700, ". " * 900, "१" * 900, "ж" * 950, "\t" * 800 + " "):
        text = "".join(rnd.choice(["word ", "it's ", "12a", "，", "  ", "\n"]) for _ in range(rnd.randint(0, 80))) + run + rnd.choice(["", "x", " end", "\n\nz", "'s 5"]) + "tail 1 " * rnd.randint(0, 60)
        ids, cut = from_blocks(enc, text, 300)
        assert ids == enc.encode_ordinary(text) == other(text), repr(run[:4])
        assert max(len(b) for b, _ in cut) <= 900


def test_a_run_of_two_million_characters_takes_many_tasks(spark):
    cut = tc.blocks("z" * 2_000_000, tc.BLOCK_CHARS)
    assert len(cut) == 8 and [kind for _, kind in cut] == [tc.GOES_ON] * 7 + [tc.LAST]
    with open(tc.TOKENIZER, "rb") as f:
        ranks = f.read()
    df = spark.createDataFrame([(1, "z" * 2_000_000)], "key long, text string")
    out = tc.long_texts(df, ranks)
    assert "Exchange hashpartitioning(row" in out._jdf.queryExecution().toString()
    got = out.first()
    assert got.key == 1 and list(got.ids) == tc.encode_piece(tc.encoder(ranks), "z" * 2_000_000)


def test_rows(spark, monkeypatch, enc):
    monkeypatch.setattr(tc, "BLOCK_CHARS", 1000)
    long = "some words, 12 more. " * 400 + "z" * 3000
    rows = [(1, None, "a"), (2, "", "b"), (3, "hi there", "c"), (3, "hi there", "d"), (None, "x", "e"), (5, long, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, list(r.ids)) for r in tc.token_ids(df, "doc_id", "text").collect()), key=repr)
    assert got == sorted([(k, enc.encode_ordinary(t) if t else []) for k, t, _ in rows], key=repr)
    assert tc.token_ids(df.limit(0), "doc_id", "text").collect() == []

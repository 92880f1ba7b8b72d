"""Cross-parsing: the automaton against plain search, phrases against a plain parse, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import language_id as lid

SPACE = np.array([32], dtype=np.uint32)


def plain_phrases(parser, name, learned, text):
    """Longest matches from left to right, by substring search, in blocks as the parser lays them out."""
    known = "".join(map(chr, parser.symbols(learned[name]).tolist()))
    symbols = "".join(map(chr, parser.symbols(lid.letters(text)).tolist()))
    count = 0
    for at in range(0, len(symbols), lid.BLOCK):
        block, i = symbols[at : at + lid.BLOCK], 0
        while i < len(block):
            n = 0
            while i + n < len(block) and ord(block[i + n]) != parser.width - 1 and block[i : i + n + 1] in known:
                n += 1
            count += 1
            i += max(1, n)
    return count


@pytest.fixture(scope="module")
def learned():
    r = random.Random(3)
    make = lambda parts: lid.letters(" ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(400)))[:1500]
    return {"x": make(["the", "and", "ing", "er"]), "y": make(["eau", "ment", "éle", "qui"])}


def test_automaton_knows_exactly_the_substrings():
    r = random.Random(5)
    for _ in range(30):
        text = [r.randint(0, 3) for _ in range(r.randint(1, 40))]
        moves = lid.suffix_automaton(text, 4)
        every = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
        for _ in range(60):
            word = tuple(r.randint(0, 3) for _ in range(r.randint(1, 6)))
            state, ok = 0, True
            for c in word:
                state = moves[state, c]
                if state == 0:
                    ok = False
                    break
            assert ok == (word in every)


def test_phrases(learned):
    parser = lid.CrossParser(learned)
    texts = ["the andinger thing", "", "x", "eau qui mentéle", "Ünknown ŽŽŽ 123 the", "a" * 1500, " ".join(["the eau and ment"] * 200), "…!?"]
    counts = parser.phrases([parser.symbols(lid.letters(t)) for t in texts])
    for t, row in zip(texts, counts):
        assert row.tolist() == [plain_phrases(parser, n, learned, t) for n in parser.names]


@pytest.mark.parametrize("text, want", [("Ab, c!", "ab c"), ("", ""), ("  12 ", ""), ("É\U00010400x", "é\U00010428x"), ("-a--b-", "a b")])
def test_letters(text, want):
    assert "".join(map(chr, lid.letters(text).tolist())) == want


def test_predictions_and_edge_cases(spark, learned, edge, nothing):
    parser = lid.CrossParser(learned)
    rows = lid.identify(edge, parser).collect()
    assert len(rows) == edge.count()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[1][0] == "x" and all(0 <= s <= 1 for _, s in got.values())
    assert lid.identify(nothing, parser).count() == 0
    # Nothing to learn from, or one language alone.
    assert {r.lang_pred for r in lid.identify(edge, lid.learn(nothing)).collect()} == {"und"}
    one = lid.CrossParser({"x": learned["x"]})
    assert one.predict(["the", ""]) == [("x", 1.0), ("und", 0.0)]


def test_learning_leaves_out_held_out_and_unlabelled_rows(spark, frame):
    ids = [i for i in range(60)]
    out = {i for i in ids if zlib.crc32(str(i).encode()) % 3 == 1}
    docs = frame(*((i, "zzzz zzzz" if i in out else "the and", "en" if i % 5 else None) for i in ids))
    parser = lid.learn(docs)
    assert parser.names == ["en"] and set(parser.alphabet.tolist()) == set(map(ord, "theand"))
    got = {r.doc_id for r in docs.select("doc_id", lid.held_out(F.col("doc_id")).alias("h")).where("h").collect()}
    assert got == out


def test_learning_is_bounded_and_repeatable(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, again = lid.learn(docs, 3000), lid.learn(docs, 3000)
    assert np.array_equal(one.table, again.table) and one.names == again.names
    assert len(one.table) <= len(one.names) * 2 * 3000 * one.width


def test_long_documents_still_teach(frame):
    docs = frame(*((i, "the quick brown fox " * 2000, "en") for i in range(30)))
    assert lid.learn(docs, 1000).names == ["en"]


def test_a_language_of_one_short_row_takes_nothing_from_the_others(spark, learned):
    alone, beside = lid.CrossParser(learned), lid.CrossParser({**learned, "a": lid.letters("ok")})
    r = random.Random(11)
    texts = [" ".join("".join(r.choice(parts) for _ in range(3)) for _ in range(20)) for parts in (["the", "and", "ing", "er"], ["eau", "ment", "éle", "qui"]) for _ in range(20)]
    want = ["x"] * 20 + ["y"] * 20
    assert [n for n, _ in alone.predict(texts)] == want == [n for n, _ in beside.predict(texts)]
    assert beside.predict(["OK, ok!"])[0][0] == "a" and beside.lengths == [2, 1500, 1500]


def test_stray_label_in_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    stray = spark.createDataFrame([(10**9 + 3, "ok", "xx")], docs.schema)
    parser = lid.learn(docs.unionByName(stray), 3000)
    assert dict(zip(parser.names, parser.lengths)) == {"de": 3000, "en": 3000, "es": 3000, "fr": 3000, "xx": 3}
    got = lid.identify(docs, parser).join(docs.select("doc_id", "lang"), "doc_id").where(lid.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


@pytest.mark.parametrize("short, long", [("the and", "1" * 3_000_000), ("an " + "1" * 300, "an")])
def test_the_bound_is_filled_with_letters(frame, short, long):
    """One huge row beside short ones, and rows that hold few letters."""
    docs = frame(*((i, short, "en") for i in range(4000)), (10**9 + 3, long, "en"))
    assert lid.learn(docs, 1000).lengths == [1000]


def test_rows_without_id_teach(frame):
    assert lid.learn(frame(*((None, f"the and {'x' * (i % 50 + 1)}", "en") for i in range(400))), 500).lengths == [500]


def scripts():
    """Words over Cyrillic, Hangul and Han: 32, 400 and 900 letters."""
    r = random.Random(7)
    parts = {"ru": [chr(c) for c in range(0x430, 0x450)], "ko": [chr(c) for c in range(0xAC00, 0xAD90)], "zh": [chr(c) for c in range(0x4E00, 0x5184)]}
    words = {k: ["".join(r.choice(v) for _ in range(r.randint(1, 4))) for _ in range(800)] for k, v in parts.items()}
    return {k: lambda n, v=v: " ".join(r.choice(v) for _ in range(n)) for k, v in words.items()}


def test_scripts_with_many_letters(learned):
    make = scripts()
    learned = {**learned, **{k: lid.letters(f(1500)) for k, f in make.items()}}
    parser = lid.CrossParser(learned)
    assert len(parser.alphabet) > 1000
    tests = [(k, f(n)) for k, f in make.items() for n in (3, 30, 300) for _ in range(10)]
    for (want, _), (got, score) in zip(tests, parser.predict([t for _, t in tests])):
        assert got == want and score > 0
    texts = [t for _, t in tests] + [make["zh"](40) + " the eau " + make["ru"](40), "\u9fa5" + make["zh"](2), make["ko"](1)]
    counts = parser.phrases([parser.symbols(lid.letters(t)) for t in texts])
    for t, row in zip(texts, counts):
        assert row.tolist() == [plain_phrases(parser, n, learned, t) for n in parser.names]


def test_one_language_beyond_the_table():
    """Every letter differs, so moves by all but the most common ones are listed."""
    learned = {"zh": lid.letters("".join(map(chr, range(0x4E00, 0x4E00 + 500)))), "ja": lid.letters("".join(map(chr, range(0x4E00 + 499, 0x4E00 - 1, -1))))}
    parser = lid.CrossParser(learned)
    texts = ["".join(map(chr, range(0x4E00 + 100, 0x4E00 + 180))), "".join(map(chr, range(0x4E00 + 180, 0x4E00 + 100, -1)))]
    assert parser.phrases([parser.symbols(lid.letters(t)) for t in texts]).tolist() == [[80, 1], [1, 80]]
    assert [n for n, _ in parser.predict(texts)] == ["zh", "ja"]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = lid.op6_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 250 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)


def test_many_languages_share_a_bound(spark, frame):
    """Two hundred languages, each of words of its own: the model stays within its bound and still tells them apart."""
    r = random.Random(4)
    words = {f"l{k:03d}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 7))) for _ in range(40)] for k in range(200)}
    text = lambda k, n: " ".join(r.choice(words[k]) for _ in range(n))
    docs = frame(*((i, text(k, 150), k, "s") for i, k in enumerate(list(words) * 4)))
    parser = lid.learn(docs, chars_in_all=100_000)
    learnable = {k for i, k in enumerate(list(words) * 4) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert parser.names == sorted(learnable) and max(parser.lengths) <= 100_000 // len(learnable)
    assert sum(a.table.nbytes for a in parser.automata) < 40 << 20
    got = parser.predict([text(k, 60) for k in list(words)[:40]])
    assert sum(name == k for (name, _), k in zip(got, words)) >= 38
    assert len(lid.learn(docs, most_languages=7).names) == 7

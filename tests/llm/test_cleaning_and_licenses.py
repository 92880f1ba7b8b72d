"""Line cleaning and license scans against plain Python by the contract's words."""

import re
from collections import Counter

import pytest

from tickloom.llm import license_scan as ls
from tickloom.llm import line_cleaning as lc

SPACE = r"[^\x20\x09-\x0D]+"


def base(text):
    """The contract's base figures, word by word."""
    words = re.findall(SPACE, text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_figures(spark, sf_dir, edge):
    for docs in (edge, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        texts = {r.doc_id: r.text for r in docs.collect()}
        got = lc.clean(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            assert tuple(r[n] for n in NAMES) == base(texts[r.doc_id])
            assert not (r.base_failed and r.kept)


def test_repeated_words_with_many_different_words():
    words = [str(i).encode() for i in range((1 << 20) + 10)] + [b"a", b"b", b"c"] * 2
    assert lc.repeated_words(words) == 6
    assert lc.repeated_words([b"a"] * 3) == 0
    assert lc.repeated_words([b"a"] * 4) == 4


PROSE = "\n".join(f"Sentence {i} goes{i} on for{i} a while{i}, and{i} then it{i} comes to{i} an end{i}." for i in range(8))


@pytest.mark.parametrize(
    "line",
    [
        "Home | About | Contact | News",
        "All rights reserved.",
        "Please enable JavaScript to go on.",
        "the*** of%%% and&&& or### but$$$ so***",
        "WORD!! THE!! OF!! AND!! OR!! BUT!!",
        "a line of ten words that has no mark at all here",
        PROSE.split("\n")[3],
    ],
)
def test_failing_lines_go(line):
    text, figures = lc.clean_text(f"{PROSE}\n{line}".encode())
    assert text.decode() == PROSE and figures["n_removed_lines"] == 1 and figures["kept"]


@pytest.mark.parametrize("line", ["Short title", "He said: it costs $5, or 4% more.", "Ça va très bien, merci…", "Why? Because it is so!"])
def test_plain_lines_stay(line):
    text, figures = lc.clean_text(f"{PROSE}\n\n{line}".encode())
    assert text.decode() == f"{PROSE}\n\n{line}" and figures["n_removed_lines"] == 0


@pytest.mark.parametrize("odd", ["|", "_", "=", "a$b", "x^2"])
def test_one_symbol_does_not_excuse_missing_sentence_marks(odd):
    line = f"home news sport weather culture travel science money {odd} jobs cars maps shop"
    assert lc.line_fails(line.encode(), line.encode().split(), set(), lc.phrases(()))


def test_documents_that_lose_too_much_go():
    junk = "\n".join(f"Home{i} | About{i} | Contact{i} | News{i}" for i in range(60))
    text, figures = lc.clean_text(f"{PROSE}\n{junk}".encode())
    assert text.decode() == PROSE and not figures["base_failed"] and not figures["kept"]


def test_verdicts_follow_quality(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in lc.op2_line_cleaning(spark, sf_dir).collect() if r.doc_id in labels and not r.base_failed]
    assert len(rows) > 20 and sum(r.kept == bool(labels[r.doc_id]) for r in rows) >= 0.97 * len(rows)


def test_cleaning_edge_cases(edge, nothing):
    got = {r.doc_id: r for r in lc.clean(edge).collect()}
    assert got[2].cleaned == "" and got[2].n_words == 0 and got[2].base_failed
    assert got[4].cleaned == " \n\t " and got[6].n_words == 60_000
    assert lc.clean(nothing).count() == 0


BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def scan_plainly(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places(spark, sf_dir, edge, frame):
    made = frame(
        (1, "MIT License, mit-license mit  LICENSE. Apache license"),
        (2, "cc by cc by cc by; GNU General\nPublic License"),
        (3, "permit license, mit licenses, cc\xa0by, éapache license"),
        (4, "the apache license " * 500),
    )
    for docs in (made, edge, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        texts = {r.doc_id: r.text for r in docs.collect()}
        for r in ls.scan(docs).collect():
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == scan_plainly(texts[r.doc_id])
            own = set(filter(None, r.labels.split(",")))
            assert set(filter(None, r.base_labels.split(","))) <= own and r.labels == ",".join(sorted(own))
            assert 0 <= r.score <= 1 and (r.score > 0) == bool(own)


@pytest.mark.parametrize(
    "text, postfix",
    [
        ("mit", ["mit"]),
        ("mit or apache-2.0 and bsd-3-clause", ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]),
        ("(mit or apache-2.0) and isc", ["mit", "apache-2.0", "or", "isc", "and"]),
        ("gpl-2.0 with classpath-exception-2.0 or mit", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "or"]),
        ("mit or", None), ("or mit", None), ("(mit", None), ("mit)", None), ("mit isc", None), ("", None), ("()", None),
    ],
)
def test_shunting_yard(text, postfix):
    assert ls.to_postfix(text) == postfix


@pytest.mark.parametrize(
    "text, labels, verdict",
    [
        ("MIT", {"mit"}, True),
        ("GPL-3.0-only", {"gpl"}, False),
        ("GPL-2.0-only OR MIT", {"gpl", "mit"}, True),
        ("GPL-2.0-only AND MIT", {"gpl", "mit"}, False),
        ("MIT OR GPL-2.0-only AND GPL-3.0-only", {"gpl", "mit"}, True),
        ("(MIT OR GPL-2.0-only) AND GPL-3.0-only", {"gpl", "mit"}, False),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, False),
        ("MIT OR OR", {"mit"}, None),
    ],
)
def test_expressions(text, labels, verdict):
    assert ls.evaluate(text) == (labels, verdict)


def test_tags(frame, nothing):
    docs = frame(
        (1, "// SPDX-License-Identifier: MIT OR Apache-2.0\ncode"),
        (2, "/* SPDX-License-Identifier: (GPL-2.0-only AND MIT) */"),
        (3, "spdx-license-identifier: broken and"),
        (4, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-3.0-only"),
    )
    got = {r.doc_id: (r.labels, r.permissive, r.n_tags) for r in ls.scan(docs).collect()}
    assert got == {1: ("apache,mit", True, 1), 2: ("gpl,mit", False, 1), 3: ("", None, 1), 4: ("gpl,mit", False, 2)}
    assert ls.scan(nothing).count() == 0


@pytest.mark.parametrize(
    "line",
    [
        "यह एक लंबा वाक्य है जिसमें दस से अधिक शब्द हैं और यह यहाँ समाप्त होता है।",
        "یہ ایک لمبا جملہ ہے جس میں دس سے زیادہ الفاظ ہیں اور یہ یہاں ختم ہوتا ہے۔",
        "هل هذه جملة طويلة فيها أكثر من عشر كلمات وتنتهي هنا بعلامة استفهام؟",
        "ይህ ከአስር በላይ ቃላት ያለው ረጅም ዓረፍተ ነገር ነው እና እዚህ ላይ ያበቃል።",
        "ဒါ က စကား လုံး ဆယ် လုံး ထက် ပို တဲ့ ရှည် လျား တဲ့ ဝါကျ ဖြစ် တယ်။",
        "นี่ คือ ประโยค ยาว ที่ มี คำ มาก กว่า สิบ คำ และ จบ ตรง นี้",
        "これ は 十 語 より 長い 文 で あり ここ で 終わり ます。",
    ],
)
def test_sentences_of_other_scripts_stay(line):
    assert len(line.split()) >= lc.LONG_LINE
    assert lc.clean_text(line.encode())[0].decode() == line


def test_phrases_are_a_table_by_language():
    for notice in ("Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados"):
        assert lc.clean_text(f"{PROSE}\n{notice}".encode())[0].decode() == PROSE
    own = {"eo": ("ĉiuj rajtoj",)}
    assert lc.clean_text(f"{PROSE}\nĉiuj rajtoj".encode(), own)[0].decode() == PROSE
    assert lc.clean_text(f"{PROSE}\nAll rights reserved.".encode(), own)[0].decode().endswith("reserved.")
    assert lc.clean_text(f"{PROSE}\nAll rights reserved.".encode(), {})[0].decode().endswith("reserved.")

"""One long text of an odd form must not stall a task: every operator on a megabyte of each, within a time."""

import time

import pytest
import public_tokenizers
import tiktoken

from tickloom.llm import (
    byte_bpe, exact_dedup, jaccard_join, language_id, license_scan, line_cleaning, mixing, periodic_runs, pieces,
    quality_rules, simhash_anchors, token_counts, token_shards,
)
from tickloom.llm.common import scratch, stored

TAG = "SPDX-License-Identifier: MIT "
TEXTS = {
    "one character": "a" * 1_000_000,
    "two letters": "ha" * 500_000,
    "zeros": "0" * 1_000_000,
    "stars": "*" * 1_000_000,
    "one line": "some words, and more " * 48_000,
    "no spaces": "水火山人" * 83_000,
    "short lines": "x\n" * 500_000,
    "tags": TAG * 20_000 + "x" * 400_000,
    "one expression": "SPDX-License-Identifier: " + " AND ".join(f"a{i}" for i in range(100_000)),
}


@pytest.fixture(scope="module")
def long_texts(frame):
    few = [(i, f"A usual text number {i} with some words in it. And another line.", "en", "a") for i in range(40)]
    return frame(*((100 + i, t, "en", "b") for i, t in enumerate(TEXTS.values())), *few)


def operators():
    word, byte, ranks = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))

    def shards(docs):
        folder = scratch(docs.sparkSession, "long-shards")
        token_shards.write_shards(docs, word, folder, end_id=1, shards=2)
        return token_shards.read_shards(docs.sparkSession, folder)

    def labelled(docs):
        return docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")

    return {
        "op1": shards,
        "op2": line_cleaning.clean,
        "op3": license_scan.scan,
        "op4": mixing.mix,
        "op5": lambda docs: token_counts.count_tokens(docs, byte),
        "op6": lambda docs: language_id.identify(docs, language_id.learn(docs)),
        "op7": lambda docs: byte_bpe.round_trip(docs, ranks),
        "op8": lambda docs: quality_rules.classify(docs, labelled(docs)),
        "op9": lambda docs: jaccard_join.groups(docs),
        "op10": exact_dedup.groups,
        "op11": simhash_anchors.groups,
        "op12": periodic_runs.find_runs,
    }


@pytest.mark.parametrize("name", operators())
def test_whole_operators(long_texts, name):
    began = time.time()
    assert stored(operators()[name](long_texts), "long").count() >= long_texts.count()
    assert time.time() - began < 60


@pytest.mark.parametrize("name", TEXTS)
def test_byte_bpe_equals_the_library(name):
    text, path = TEXTS[name], public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bpe = byte_bpe.load(path, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    began = time.time()
    ids = bpe.merged(text)
    assert time.time() - began < 30
    assert ids == library.encode_ordinary(text) and bpe.decode(ids) == text.encode()


def test_tags_on_one_line():
    began = time.time()
    *_, labels, score, permissive, n_tags = license_scan.scan_text(TEXTS["tags"].encode())
    assert (labels, score, permissive, n_tags) == ("mit", 1.0, True, 20_000)
    license_scan.scan_text(TEXTS["one expression"].encode())
    assert time.time() - began < 4


def test_each_tag_has_its_own_expression():
    text = b"SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-3.0-only OR MIT */ not this */\nSPDX-License-Identifier: (broken"
    *_, labels, _, permissive, n_tags = license_scan.scan_text(text)
    assert (labels, permissive, n_tags) == ("gpl,mit", True, 3)
    assert license_scan.evaluate("MIT AND (GPL-2.0-only WITH Classpath-exception-2.0 OR BSD-3-Clause)") == ({"mit", "gpl", "bsd"}, True)


def test_long_pieces_are_not_remembered():
    cache = pieces.PieceCache(pieces.tokenizer(public_tokenizers.path("byte_bpe_50k.json")), lambda _, ids: len(ids))
    texts = [TEXTS["no spaces"].encode(), b"a short one. " + b"y" * 500 + b". " + b"z" * 300 + b"\nend"]
    first = [sum(x) for x in cache.values(texts)]
    assert first == [sum(x) for x in cache.values(texts)] and not cache.passing
    assert max(map(len, [*cache.first, *cache.rest])) <= pieces.LONGEST

"""Tables that a Python worker keeps from task to task go when tasks of another operator begin."""

import gc

import public_tokenizers

from tickloom.llm import byte_bpe, token_counts
from tickloom.llm.common import kept, let_go, per_row, tidy
from tickloom.llm.pieces import tokenizer


def test_other_operators_run_without_token_tables(spark):
    def held():
        """A column with the number of token tables that lie in the worker."""
        names = ("PieceCache", "ByteBpe")
        return lambda batch: {"n": [sum(type(x).__name__ in names for x in gc.get_objects())] * batch.num_rows}

    docs = spark.range(64).selectExpr("id AS doc_id", "concat('word ', id, ' and more') AS text").repartition(16)
    keep = [("doc_id", "doc_id"), ("text", "text")]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert byte_bpe.round_trip(docs, path).count() == 64
    assert {r.n for r in per_row(docs, held, keep, "n long").collect()} == {0}
    assert byte_bpe.decode(byte_bpe.encode(docs, path), path).count() == 64
    assert token_counts.encoded(docs.withColumnRenamed("doc_id", "content"), public_tokenizers.path("byte_bpe_50k.json")).count() == 64
    assert {r.n for r in per_row(docs, held, keep, "n long").collect()} == {0}


def test_kept_tables_are_made_once_and_one_of_a_kind():
    made = []
    let_go()
    for key in ("a", "a", "b", "b"):
        assert kept("test", key, lambda: made.append(key) or key.upper()) == key.upper()
    assert made == ["a", "b"]
    let_go()
    assert kept("test", "b", lambda: 7) == 7
    let_go()
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert tokenizer(path) is tokenizer(path)


def test_tasks_that_keep_find_what_was_kept():
    let_go()
    mine = kept("test", 1, list)
    assert list(tidy(lambda batches: batches, keeps=True)(iter("ab"))) == ["a", "b"]
    assert kept("test", 1, list) is mine
    assert list(tidy(lambda batches: batches)(iter("ab"))) == ["a", "b"]
    assert kept("test", 1, list) is not mine
    let_go()

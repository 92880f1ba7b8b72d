"""Rules from trees, their weights as a column, held-out ranking."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.llm import quality_rules as q


def test_statistics(edge, nothing):
    rows = q.statistics(edge).collect()
    assert len(rows) == edge.count()
    got = {r.doc_id: r for r in rows}
    assert got[1].words == 13 and got[1].distinct_share == 1 and got[1].sentence_end_share == 1
    assert got[2].words == got[3].words == got[4].words == 0
    assert all(math.isfinite(r[s]) for r in rows for s in q.STATISTICS)
    assert q.statistics(nothing).count() == 0
    odd = q.statistics_of(b"A a a a | b*** !!\nA a a a | b*** !!")
    named = dict(zip(q.STATISTICS, odd))
    assert named["dup_line_share"] == 0.5 and named["separator_share"] == 2 / 14 and named["odd_word_share"] == 6 / 14


def test_rules_are_paths():
    printed = """RandomForestClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 3.5)
     If (feature 3 <= 1.0E-4)
      Predict: 0.0
     Else (feature 3 > 1.0E-4)
      Predict: 1.0
    Else (feature 0 > 3.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 0 <= 3.5)
     Predict: 0.0
    Else (feature 0 > 3.5)
     Predict: 1.0
"""
    low, few, many, high = ("words", "<=", 3.5), ("symbol_share", "<=", 1e-4), ("symbol_share", ">", 1e-4), ("words", ">", 3.5)
    assert q.rules_of(printed) == [(low,), (low, few), (low, many), (high,)]


def test_score_is_the_weighted_sum(spark):
    rules = {(("words", "<=", 3.0),): 1.5, (("words", ">", 1.0), ("upper_share", ">", 0.5)): -2.0}
    rows = spark.createDataFrame([(1.0, 0.9), (2.0, 0.9), (9.0, 0.9), (9.0, 0.1)], "words double, upper_share double")
    got = [r[0] for r in rows.select(q.RuleEnsemble(rules, 0.25).score()).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-x)) for x in (1.75, -0.25, -1.75, 0.25)])


def labelled(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_without_two_classes(spark, edge):
    assert {r.score for r in q.classify(edge, labelled(spark)).collect()} == {0.5}
    ones = q.classify(edge, labelled(spark, (1, 1, 0), (5, 1, 0), (6, 1, 0), (None, 1, 0), (2, None, 0)))
    assert all(r.score > 0.5 and r.predicted == 1 for r in ones.collect())


def test_held_out_rows_are_not_learned_from(spark, edge):
    stats = q.statistics(edge)
    every = labelled(spark, *((i, i % 2, 0) for i in range(1, 7)))
    free = {i for i in range(1, 7) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert q.training_rows(stats, every).count() == stats.where(F.col("doc_id").isin(list(free))).count()


def test_bound_on_training_rows(spark, sf_dir):
    stats = q.statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    every = q.training_rows(stats, labels).count()
    assert 0.2 * every < q.training_rows(stats, labels, max_rows=every // 2).count() < 0.8 * every


def test_empty_table(spark, nothing):
    assert q.classify(nothing, labelled(spark, (1, 1, 0))).count() == 0
    assert q.keep_good(nothing, labelled(spark)).columns == nothing.columns


def test_held_out_ranking_and_kept_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = q.op8_quality_rules(spark, sf_dir)
    assert rows.count() == docs.count()
    held = rows.join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    auc = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert auc >= 0.95 and all(0 <= r.score <= 1 for r in held)
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows.where("predicted = 1").collect()}


def plain_statistics(text):
    """The statistics by their names, word by word and line by line."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [x for x in data.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    n, chars, many = max(1, len(words)), max(1, sum(map(len, words))), max(1, len(lines))
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    count = lambda pattern: len(re.findall(pattern, data))
    separators = {x.encode() for x in ("|", "||", ">", ">>", "/", "»", "›", "•", "·")}
    return {
        "words": len(words), "word_length": sum(map(len, words)) / n, "line_words": len(words) / many,
        "symbol_share": count(rb"[#*$%&|<>]") / chars,
        "odd_word_share": sum(bool(re.search(rb"[#*$%&|<>{}\\^~=_]|[!?]{2}", w)) for w in words) / n,
        "separator_share": sum(w in separators for w in words) / n,
        "upper_share": count(rb"[A-Z]") / max(1, count(rb"[A-Za-z]")), "digit_share": count(rb"[0-9]") / chars,
        "distinct_share": len(set(words)) / n, "repeat_share": len(repeated) / n, "dup_line_share": 1 - len(set(lines)) / many,
        "sentence_end_share": sum(bool(re.search('([.!?…。]|\\.")$', x.decode().rstrip(" \t\r\x0b\x0c"))) for x in lines) / many,
        "comma_share": count(b",") / n, "longest_word": max(map(len, words), default=0),
    }


def test_query_against_a_plain_recomputation(spark, edge):
    """Statistics, rules and the score of every row, from the learned rules and weights alone; ties at 0.5 count as 1."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats, model = q.learned(docs, labels)
    assert len(model.weights) > 3
    got = {r.doc_id: r for r in stats.select("*", model.score().alias("score")).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(texts) == len(got)
    for d in texts:
        own = plain_statistics(d.text)
        assert {s: got[d.doc_id][s] for s in q.STATISTICS} == pytest.approx(own, abs=1e-12)
        own = {s: got[d.doc_id][s] for s in q.STATISTICS}
        total = model.intercept
        for rule, weight in model.weights.items():
            if all(own[s] <= v if op == "<=" else own[s] > v for s, op, v in rule):
                total += weight
        assert got[d.doc_id].score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
    half = q.Constant(0.5)
    assert {r.p for r in edge.select((half.score() >= 0.5).cast("int").alias("p")).collect()} == {1}

"""Mixing: targets by repeated sharing, copies by draw."""

import re

import pytest
from pyspark.sql import functions as F

from compare import connection, difference
from tickloom.llm import mixing


def share(sizes, most=3):
    """Targets by the contract, step by step: share out, cap, share the excess of the capped again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if target[s] >= most * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: most * sizes[s] for s in over}


CASES = [
    {"a": 10, "b": 1000, "c": 1, "d": 50, None: 7},
    {"a": 5},
    {None: 3},
    {"a": 0, "b": 0},
    {"a": 0, "b": 9},
    {"z": 100, "é": 1, "Z": 100, "": 3, "aa": 4, "ab": 0},
    {f"s{i}": (i * 7919) % 101 for i in range(40)},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(share(sizes))
    if sum(sizes.values()):
        assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_targets_of_nothing(spark, nothing):
    assert mixing.targets(spark.createDataFrame([], "source string, source_size long")).count() == 0
    assert mixing.plan(nothing).count() == 0 == mixing.mix(nothing).count()


def test_plan_and_mix_agree(spark, sf_dir, edge):
    for docs in (edge, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        plan = mixing.plan(docs)
        assert plan.count() == docs.count()
        copies = plan.groupBy("doc_id").agg(F.sum("copies").alias("n"))
        mixed = mixing.mix(docs)
        assert mixed.columns == docs.columns
        taken = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
        assert taken == {r.doc_id: r.n for r in copies.collect() if r.n}
        assert {r.copies for r in plan.collect()} <= {0, 1, 2, 3}
        for r in plan.collect():
            rate = r.target / r.source_size if r.source_size else 0
            assert int(rate) <= r.copies <= int(rate) + (rate > int(rate))


def test_words_are_counted(edge):
    texts = {r.doc_id: r.text for r in edge.collect()}
    for r in mixing.plan(edge).collect():
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))


def test_words_taken_come_near_the_targets(spark, frame, sf_dir):
    """Each source takes its target to half a document, whatever the documents are like and for every seed."""
    like = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))
    odd = frame(*((i, "w " * (5000 if i % 50 == 0 else i % 9), "en", f"s{i % 4}") for i in range(400)))
    for docs in (like, odd, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")):
        for seed in (0, 1):
            rows = mixing.plan(docs, seed)
            out = rows.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("size").alias("longest"))
            for r in out.collect():
                assert abs(r.taken - r.target) <= r.longest / 2 + 1e-6


def test_bounds_equal_a_plain_walk(spark, edge):
    rows = [("a", i * i % 13, (i * 7919 + 3) % 50 << 31 | i % 3) for i in range(300)] + [("b", 5, 9), ("b", 7, 9), (None, 0, 4), ("c", 1000, 1), ("d", 1, 1 << 39)]
    df = spark.createDataFrame(rows, "source string, size long, draw long")
    for r in mixing.bounds(df).collect():
        own = sorted((d, s) for source, s, d in rows if source == r.source)
        need = r.target - r.whole * r.source_size
        taken = sum(s for d, s in own if d <= r.upto)
        sums, total = [0], 0
        for d in sorted({d for d, _ in own}):
            total += sum(s for x, s in own if x == d)
            sums.append(total)
        assert abs(taken - need) == min(abs(x - need) for x in sums)


def test_draws_are_fixed_and_differ_by_seed(spark):
    ids = spark.range(1000).selectExpr("id AS doc_id", "'x' AS text")
    one, again, other = ([r[0] for r in ids.select(mixing.draw(s)).collect()] for s in (0, 0, 1))
    assert one == again != other and all(0 <= x < 1 << 40 for x in one) and 0.45 < sum(one) / 1000 / 2**40 < 0.55
    lone = spark.createDataFrame([(None, "a"), (None, "b"), (None, "a")], "doc_id long, text string").select(mixing.draw(0)).collect()
    assert lone[0] == lone[2] != lone[1]


@pytest.mark.parametrize("name", ["draw", "__draw", "copy", "of", "whole", "upto", "rate", "OF", "size", "target"])
def test_clashing_names(frame, name):
    docs = frame(*((i, "some words " * i, "en", "ab"[i % 2]) for i in range(9))).withColumn(name, F.concat(F.lit("own "), F.col("doc_id").cast("string")))
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert all(r[name] == f"own {r.doc_id}" for r in out.collect())


def test_sql(spark, sf_dir):
    assert difference(spark, connection(sf_dir), mixing.op4_mixing, mixing.OP4_SQL, sf_dir) is None


def test_no_python_in_the_plan(spark, sf_dir):
    plan = mixing.op4_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

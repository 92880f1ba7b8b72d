"""Exact deduplication: groups by bytes, state that goes on, digests that clash."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from compare import connection, difference
from tickloom.llm import exact_dedup as dedup
from tickloom.llm.common import scratch
from tickloom.session import child_names


def plainly(docs):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(docs, out):
    want, texts = plainly(docs), defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(r.text or "")
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert any((r.keep_id, r.group_size) == want[t] for t in texts[r.doc_id])
    assert sum(r.kept for r in rows) == len(want)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_groups(edge):
    check(edge, dedup.groups(edge))


def test_clashing_digests_are_told_apart(edge, frame):
    few = lambda text: F.substring(dedup.sha256(text), 1, 1)  # noqa: E731  sixteen digests
    check(edge, dedup.groups(edge, digest=few))
    docs = frame(*((i, f"text {i % 40}") for i in range(200)))
    check(docs, dedup.groups(docs, digest=few))


def test_dedup_keeps_whole_rows(edge):
    out = dedup.dedup(edge)
    assert out.columns == edge.columns
    assert sorted((r.text or "") for r in out.collect()) == sorted(plainly(edge))
    # Rows that do not come from files do as well.
    assert dedup.dedup(edge.limit(100)).count() == out.count()


def test_state_goes_on(spark, frame):
    arrivals, state = scratch(spark, "arrivals"), scratch(spark, "state")
    first = frame((5, "a"), (1, "a"), (2, "b"))
    check(first, dedup.groups(first, arrivals, state))
    second = frame((9, "a"), (3, "c"), (0, "b"))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in dedup.groups(second, arrivals, state).collect()}
    assert got == {9: (9, 3, True), 3: (3, 1, True), 0: (2, 2, False)}


def test_bytes_of_earlier_runs_are_compared(spark, frame):
    """All texts share one digest: only the bytes, read where the locators of earlier runs say, tell them apart."""
    arrivals, state = scratch(spark, "arrivals"), scratch(spark, "state")
    same = lambda text: F.lit("0")
    runs = [
        [(5, "a"), (1, "a"), (2, "b")],
        [(9, "a"), (3, "c"), (0, "b"), (4, "new")],
        [(7, None), (8, "c"), (10, "a")],
    ]
    seen = []
    for n, rows in enumerate(runs):
        docs = frame(*rows)
        if n == 1:  # not straight from files: its stored copy is what a later run reads
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen += rows
        out = dedup.groups(docs, arrivals, state, digest=same)
        want = {i: max(j for j, t in seen if t == text) for i, text in rows}
        size = {i: sum(t == text for _, t in seen) for i, text in rows}
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in out.collect()} == {i: (want[i], size[i], want[i] == i) for i, _ in rows}


def test_rows_that_share_a_row_of_a_file(spark, frame):
    docs = frame((1, "a"), (2, "b"), (3, "a"))
    for twice in (
        docs.withColumn("n_words", F.explode(F.array(F.lit("x"), F.lit("y")))),
        docs.unionByName(docs),
        docs.join(spark.range(2).withColumnRenamed("id", "other")),
    ):
        check(twice, dedup.groups(twice))
        assert sorted(r.text for r in dedup.dedup(twice).collect()) == ["a", "b"]


def test_clashing_names(spark, frame):
    names = ["locator", "__locator", "digest", "c0", "c1", "keep_id", "_metadata", "group_size", "text_", "kept"]
    docs = frame((1, "a"), (2, "b"), (3, "a"), (None, "b"))
    docs = docs.select("*", *(F.concat(F.lit(n), "text").alias(n) for n in names))
    from tickloom.llm.common import stored

    for rows in (docs, stored(docs, "names")):
        check(rows, dedup.groups(rows))
        out = dedup.dedup(rows)
        assert out.columns == rows.columns
        assert sorted(tuple(r[n] for n in ["doc_id", *names]) for r in out.collect()) == [(i, *(n + t for n in names)) for i, t in ((2, "b"), (3, "a"))]


@pytest.mark.parametrize("batches", [1, 2, 30])
def test_state_in_batches(spark, frame, batches):
    docs = frame(*((i, f"t{i % 3}") for i in range(30))).repartition(6)
    arrivals, state = scratch(spark, "arrivals"), scratch(spark, "state")
    check(docs, dedup.groups(docs, arrivals, state, batches=batches))


def test_several_batches_by_default(spark, frame):
    docs = frame(*((i, f"t{i % 7}") for i in range(3000))).repartition(8)
    arrivals, state = scratch(spark, "arrivals"), scratch(spark, "state")
    check(docs, dedup.groups(docs, arrivals, state))
    assert len([n for n in child_names(spark, f"{state}/commits") if n.isdigit()]) > 1


def test_nothing(nothing):
    assert dedup.groups(nothing).count() == 0 == dedup.dedup(nothing).count()


def test_large_group_is_compared_in_parts(frame, monkeypatch):
    monkeypatch.setattr(dedup, "PART", 10)
    docs = frame(*((i, "same" if i % 2 else f"own {i}") for i in range(300)))
    check(docs, dedup.groups(docs))


def test_sql(spark, sf_dir):
    assert difference(spark, connection(sf_dir), dedup.op10_exact_dedup, dedup.OP10_SQL, sf_dir) is None


def test_no_python_and_no_settings_left_behind(spark, sf_dir):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    out = dedup.op10_exact_dedup(spark, sf_dir)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before

import datetime as dt
import json

import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom import schemas, session
from tickloom.operators.quality import QualityError
from tickloom.sources import lake, payloads, sinks

PRICES = schemas.RAW_PRICES


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def line(symbol, price, day="2024-01-01"):
    return json.dumps({"symbol": symbol, "price": price, "timestamp": f"{day} 00:00:00", "ingestion_date": day}) + "\n"


def test_jsonl_glob_over_days(spark, tmp_path):
    write(tmp_path / "raw/coingecko/2024-01-01/data.jsonl", line("a", 1.0))
    write(tmp_path / "raw/coingecko/2024-01-02/data.jsonl", line("b", 2, "2024-01-02") + line("c", None))
    df = lake.read_json_lines(spark, f"{tmp_path}/raw/coingecko/*/data.jsonl", PRICES)
    assert rows(df.select("symbol", "price")) == [("a", 1.0), ("b", 2.0), ("c", None)]


def test_bad_lines_stay_visible_on_request(spark, tmp_path):
    write(tmp_path / "d.jsonl", line("a", 1.0) + "{broken\n")
    df = lake.read_json_lines(spark, str(tmp_path / "d.jsonl"), PRICES, keep_corrupt=True).cache()
    assert rows(df.select("symbol", lake.CORRUPT)) == [("a", None), (None, "{broken")]


def test_required_read_raises_on_empty(spark, tmp_path):
    write(tmp_path / "d.jsonl", "")
    with pytest.raises(QualityError):
        lake.read_required_json_lines(spark, str(tmp_path / "d.jsonl"), PRICES)


def test_mixed_json_by_suffix_and_bad_files(spark, tmp_path):
    write(tmp_path / "a/2024-01-01/data.jsonl", line("a", 1.0) + line("b", 2.0))
    write(tmp_path / "a/2024-01-02/data.json", json.dumps([json.loads(line("c", 3.0)), json.loads(line("d", 4.0))], indent=1))
    write(tmp_path / "a/2024-01-03/data.json", json.dumps(json.loads(line("e", 5.0)), indent=2))
    write(tmp_path / "a/2024-01-04/data.jsonl", line("f", 6.0) + "{broken\n" + line("g", "n/a"))
    write(tmp_path / "a/bad.json", "[{")
    write(tmp_path / "a/other.txt", line("x", 9.0))
    df = lake.read_mixed_json(spark, str(tmp_path / "a"), PRICES)
    assert rows(df.select("symbol", "price")) == [("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 4.0), ("e", 5.0), ("f", 6.0), ("g", None)]
    assert df.count() == 7


def test_mixed_json_goes_by_content(spark, tmp_path):
    import gzip

    write(tmp_path / "a/x.json", line("a", 1.0) + line("b", 2.0) + line("c", 3.0))
    (tmp_path / "a/y.jsonl.gz").write_bytes(gzip.compress((line("d", 4.0) + line("e", 5.0)).encode()))
    write(tmp_path / "a/z.jsonl", json.dumps(json.loads(line("f", 6.0)), indent=2))
    write(tmp_path / "a/one.json", "[" + line("g", 7.0).strip() + "," + line("h", 8.0).strip() + "]")
    write(tmp_path / "a/half.jsonl", line("i", 9.0) + "{broken\n[1\n")
    write(tmp_path / "a/none.json", "{\n broken")
    mixed = lake.MixedJson(spark, str(tmp_path / "a"))
    assert rows(mixed.rows(PRICES).select("symbol", "price")) == [(c, float(i + 1)) for i, c in enumerate("abcdefghi")]
    assert sorted((f.rsplit("/", 1)[1], n) for f, n in rows(mixed.skipped())) == [("half.jsonl", 2), ("none.json", 2)]
    report = sinks.compact_report(spark, str(tmp_path / "a"), str(tmp_path / "out"), PRICES)
    assert report == {"rows": 9, "skipped_lines": 4, "skipped_files": 2, "set_aside": 1}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9


def test_mixed_json_reads_large_documents(spark, tmp_path):
    """Above 64 MB, and above a limit that only holds for single records."""
    records = [{**json.loads(line(f"s{i}", float(i))), "note": 'a "quoted, [{text}]" \\ ' + "x" * 1_000_000} for i in range(70)]
    write(tmp_path / "a/large.json", json.dumps(records, indent=2))
    write(tmp_path / "b/many.json", json.dumps([json.loads(line(f"s{i}", float(i))) for i in range(30_000)], indent=2))
    write(tmp_path / "b/cut.json", json.dumps([json.loads(line(f"s{i}", float(i))) for i in range(30_000)], indent=2)[:-1])
    write(tmp_path / "b/comma.json", json.dumps([1, 2], indent=2)[:-2] + ",\n]")
    mixed = lake.MixedJson(spark, str(tmp_path / "a"))
    assert rows(mixed.rows(PRICES).select("symbol", "price")) == sorted((f"s{i}", float(i)) for i in range(70))
    assert mixed.skipped().isEmpty()
    mixed = lake.MixedJson(spark, str(tmp_path / "b"), document_bytes=1000)
    assert mixed.rows(PRICES).select("symbol").distinct().count() == mixed.rows(PRICES).count() == 30_000
    assert sorted(f.rsplit("/", 1)[1] for f, _ in rows(mixed.skipped())) == ["comma.json", "cut.json"]


def test_mixed_json_sets_files_aside_by_name(spark, tmp_path):
    """Too large a record and no record at all: these files are named, the others are read and compacted."""
    root = tmp_path / "odd name #1"
    write(root / "a/huge.json", json.dumps([{"symbol": "a"}, {"symbol": "b", "note": ["x" * 100] * 20}], indent=2))
    write(root / "a/late.json", json.dumps([{"symbol": f"s{i}"} for i in range(100)] + [{"note": ["x" * 100] * 20}]).replace("}, {", "},\n{"))
    write(root / "a/none.json", "{broken\nand more\n")
    write(root / "a/good.json", json.dumps([{"symbol": "c", "price": 1.0}], indent=2))
    write(root / "a/lines.jsonl", line("d", 2.0) + "broken\n" + line("e", 3.0))
    mixed = lake.MixedJson(spark, f"{root}/a", document_bytes=1000)
    assert rows(mixed.rows(PRICES).select("symbol", "price")) == [("c", 1.0), ("d", 2.0), ("e", 3.0)]
    got = {f.rsplit("/", 1)[1]: tuple(rest) for f, *rest in rows(mixed.files())}
    large = "a record of more than 1000 characters"
    n_lines = len((root / "a/huge.json").read_text().splitlines())
    assert got == {
        "huge.json": ("set aside", n_lines, large), "late.json": ("set aside", 101, large), "none.json": ("set aside", 2, "no record"),
        "good.json": ("document", 0, None), "lines.jsonl": ("lines", 1, None),
    }
    with pytest.warns(UserWarning, match="huge.json set aside"):
        report = sinks.compact_report(spark, f"{root}/a", f"{root}/out", PRICES, document_bytes=1000)
    assert report == {"rows": 3, "skipped_lines": n_lines + 104, "skipped_files": 4, "set_aside": 3}
    assert rows(spark.read.parquet(f"{root}/out").select("symbol")) == [("c",), ("d",), ("e",)]


def test_compaction_reads_little_and_shuffles_nothing(spark, tmp_path):
    for i in range(30):
        write(tmp_path / f"raw/{i}.jsonl", "".join(line(f"s{i}-{k}", float(k)) for k in range(200)))
    write(tmp_path / "raw/doc.json", json.dumps([json.loads(line("z", 1.0))], indent=1))
    mixed = lake.MixedJson(spark, f"{tmp_path}/raw")
    plan = mixed.records()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("MapInArrow") == 0
    folders, rows_of = mixed.parsed(PRICES, f"{tmp_path}/parsed")
    again = rows_of(spark.read.parquet(*folders))
    assert "Exchange hashpartitioning" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == 6001


def test_compacted_files_are_near_the_target(spark, tmp_path):
    for i in range(40):
        write(tmp_path / f"raw/{i}.jsonl", "".join(line(f"{i}-{k * 7919 % 10007}", k * 0.37) for k in range(400)))
    sinks.compact(spark, f"{tmp_path}/raw", f"{tmp_path}/one", PRICES)
    whole = sinks.folder_bytes(spark, f"{tmp_path}/one", "*.parquet")
    target = whole // 3
    assert sinks.compact(spark, f"{tmp_path}/raw", f"{tmp_path}/few", PRICES, target_bytes=target) == 16_000
    sizes = sorted(f.stat().st_size for f in (tmp_path / "few").iterdir() if f.name.endswith(".parquet"))
    assert 3 <= len(sizes) <= 8 and sizes[-1] <= 1.2 * target


def test_mixed_json_without_schema_keeps_drifting_columns(spark, tmp_path):
    write(tmp_path / "a/one.jsonl", '{"symbol": "a", "price": 1.5}\n{"symbol": "b", "venue": "x"}\n')
    write(tmp_path / "a/two.json", '[{"symbol": "c", "rank": 3}]')
    df = lake.read_mixed_json(spark, str(tmp_path / "a"))
    assert rows(df.select("symbol", "price", "venue", "rank")) == [("a", 1.5, None, None), ("b", None, "x", None), ("c", None, None, 3)]
    assert sinks.compact(spark, str(tmp_path / "a"), str(tmp_path / "out")) == 3


def test_mixed_json_reads_spark_written_lines_whole(spark, tmp_path):
    path = sinks.save_day(spark.range(100).selectExpr("cast(id as string) symbol", "1.0D price"), str(tmp_path), "coingecko", "2024-01-01")
    assert path.endswith("/coingecko/2024-01-01")
    assert lake.read_mixed_json(spark, str(tmp_path), PRICES).count() == 100


def test_save_day_replaces_that_day_only_and_keeps_nulls(spark, tmp_path):
    one = spark.createDataFrame([("a", None)], "symbol string, price double")
    sinks.save_day(one.union(one), str(tmp_path), "s", "2024-01-01")
    sinks.save_day(one, str(tmp_path), "s", "2024-01-02")
    sinks.save_day(one, str(tmp_path), "s", "2024-01-01")
    texts = spark.read.text(f"{tmp_path}/s/*/")
    assert rows(texts) == [('{"symbol":"a","price":null}',)] * 2


def test_save_days_keeps_other_days(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "symbol string, dt string")
    sinks.save_days(df, str(tmp_path / "s"))
    sinks.save_days(df.where("symbol = 'a'").withColumn("symbol", F.lit("z")), str(tmp_path / "s"))
    assert rows(spark.read.schema("symbol string, dt string").json(str(tmp_path / "s"))) == [("b", "2024-01-02"), ("z", "2024-01-01")]


def day_folders(spark, root):
    for i, name in enumerate(("2024-01-30", "2024-01-31", "2024-02-01", "2024-02-03")):
        spark.createDataFrame([(f"c{i}", float(i), "t")], schemas.LAKE_TABLES["coingecko_prices"]).write.parquet(f"{root}/{name}")


def test_bare_date_folders(spark, tmp_path):
    day_folders(spark, tmp_path)
    schema = schemas.LAKE_TABLES["coingecko_prices"]
    df = lake.read_day_folders(spark, str(tmp_path), schema)
    assert rows(df.select("symbol", F.col("dt").cast("string")))[0] == ("c0", "2024-01-30")
    assert df.count() == 4
    some = lake.read_day_folders(spark, str(tmp_path), schema, start=dt.date(2024, 1, 31), end=dt.date(2024, 2, 2))
    assert rows(some.select("symbol")) == [("c1",), ("c2",)]
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"2024-01-31", "2024-02-01"}


def test_day_filter_prunes_files(spark, tmp_path):
    day_folders(spark, tmp_path)
    df = lake.read_day_folders(spark, str(tmp_path), schemas.LAKE_TABLES["coingecko_prices"]).where("dt = '2024-02-01'")
    assert [r.symbol for r in df.collect()] == ["c2"]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numFiles").value()
    assert 0 < read < len(df.inputFiles())


def test_partitioned_read(spark, tmp_path):
    base = schemas.LAKE_TABLES["coingecko_prices"]
    spark.createDataFrame([("a", 1.0, "t")], base).write.parquet(f"{tmp_path}/dt=2024-01-01")
    assert rows(lake.read_partitioned(spark, str(tmp_path), base)) == [("a", 1.0, "t", dt.date(2024, 1, 1))]


def test_publish_and_append_raise_on_zero_rows(spark, tmp_path):
    write(tmp_path / "d.jsonl", line("a", 1.0))
    assert sinks.publish_parquet(spark, str(tmp_path / "d.jsonl"), str(tmp_path / "p"), PRICES) == 1
    write(tmp_path / "b.jsonl", line("a", 1.0) + "{broken\n")
    with pytest.raises(Exception, match="unreadable record"):
        sinks.publish_parquet(spark, str(tmp_path / "b.jsonl"), str(tmp_path / "b"), PRICES)
    write(tmp_path / "n.jsonl", line("a", "n/a"))
    assert sinks.publish_parquet(spark, str(tmp_path / "n.jsonl"), str(tmp_path / "n"), PRICES) == 1
    write(tmp_path / "e.jsonl", "")
    with pytest.raises(QualityError):
        sinks.publish_parquet(spark, str(tmp_path / "e.jsonl"), str(tmp_path / "p"), PRICES)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1  # as it was
    assert sinks.append_checked(spark.range(2), str(tmp_path / "r")) == 2
    assert sinks.append_checked(spark.range(3), str(tmp_path / "r")) == 3
    assert spark.read.parquet(str(tmp_path / "r")).count() == 5
    with pytest.raises(QualityError):
        sinks.append_checked(spark.range(0), str(tmp_path / "r"))


def test_compaction_of_all_sources(spark, tmp_path):
    for i in range(20):
        write(tmp_path / f"raw/coingecko/2024-01-{i + 1:02d}/data.jsonl", line("a", float(i)))
    (tmp_path / "raw/reddit").mkdir(parents=True)
    got = sinks.compact_all(spark, str(tmp_path / "raw"), str(tmp_path / "out"), {"coingecko": PRICES, "reddit": schemas.RAW_POSTS, "absent": PRICES})
    assert {name: report["rows"] for name, report in got.items()} == {"coingecko": 20, "reddit": 0, "absent": 0}
    files = [f.name for f in (tmp_path / "out/coingecko").iterdir() if f.name.startswith("part-")]
    assert len(files) == 1 and files[0].endswith(".snappy.parquet")
    many = sinks.compact(spark, str(tmp_path / "raw/coingecko"), str(tmp_path / "many"), PRICES, target_bytes=200)
    assert many == 20
    assert len([f for f in (tmp_path / "many").iterdir() if f.name.startswith("part-")]) > 1


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(lake.union_by_name([a, b])) == [(1, "x", None), (2, None, "y")]


def test_replay(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, i),) for i in range(1, 11)], "dt date")
    assert lake.replay(df, 3, dt.date(2024, 1, 10)).count() == 4


# Payloads.


def docs(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "payload string")


def at():
    return F.lit("2024-01-05 10:00:00").cast("timestamp")


def test_price_payload_file(spark, tmp_path):
    write(tmp_path / "data.json", json.dumps({"bitcoin": {"usd": 123456}, "dogecoin": {"usd": 0.25}, "x": {}}, indent=2))
    df = payloads.flatten_prices(lake.read_documents(spark, str(tmp_path / "data.json")), fetched_at=at())
    assert rows(df) == [
        ("bitcoin", "123456", "2024-01-05 10:00:00", "2024-01-05"),
        ("dogecoin", "0.25", "2024-01-05 10:00:00", "2024-01-05"),
        ("x", None, "2024-01-05 10:00:00", "2024-01-05"),
    ]


def test_older_snapshots(spark, tmp_path):
    write(tmp_path / "coins/2024-01-01/data.json", json.dumps({"bitcoin": {"usd": 10}}, indent=2))
    write(tmp_path / "coins/2024-01-02/data.json", json.dumps({"bitcoin": {"usd": 11.5}}, indent=2))
    got = rows(payloads.read_price_snapshots(spark, str(tmp_path / "coins")), "ingestion_date")
    assert got == [("bitcoin", "10", "2024-01-01 00:00:00", "2024-01-01"), ("bitcoin", "11.5", "2024-01-02 00:00:00", "2024-01-02")]

    post = {"id": "a", "title": "t", "score": 1, "created_utc": 1800000000.0, "url": "u"}
    write(tmp_path / "posts/2024-01-01/data.json", json.dumps([post, {**post, "id": "b", "created_utc": None}], indent=2))
    write(tmp_path / "posts/2024-01-02/data.jsonl", json.dumps({**post, "id": "c", "created_utc": "2024-01-02 01:02:03"}))
    got = rows(payloads.read_post_snapshots(spark, str(tmp_path / "posts")).select("id", "created_utc"))
    assert got == [("a", "2027-01-15 08:00:00"), ("b", None), ("c", "2024-01-02 01:02:03")]


def test_index_payload_drops_unreadable_items(spark):
    item = {"value": "30", "value_classification": "Fear", "timestamp": "1704067200"}
    df = payloads.flatten_index(docs(spark, {"data": [item, {**item, "value": "x"}, {**item, "timestamp": None}, {}]}, {}, {"data": []}))
    assert rows(df) == [(30, "Fear", 1704067200, "2024-01-01")]


def test_index_values_are_read_by_their_kind(spark):
    """Text has to be a whole number, a number is cut towards zero, true is one."""
    kinds = ['"12"', '" +7 "', '"1_0"', '"12.0"', "12.7", "-12.7", "12", "1e2", "true", "null", '""', "[1]"]
    items = ", ".join(f'{{"value": {v}, "value_classification": "c{i:02d}", "timestamp": "60"}}' for i, v in enumerate(kinds))
    got = rows(payloads.flatten_index(docs(spark, f'{{"data": [{items}]}}')).select("value_classification", "value"))
    assert got == [("c00", 12), ("c01", 7), ("c02", 10), ("c04", 12), ("c05", -12), ("c06", 12), ("c07", 100), ("c08", 1)]


def test_broken_documents_are_found(spark):
    df = docs(spark, {"bitcoin": {"usd": "5.5"}}, "{broken", "[1]", "", "{}")
    assert rows(payloads.flatten_prices(df, fetched_at=at()).select("symbol", "price")) == [("bitcoin", "5.5")]
    assert sorted(r["_record"] for r in payloads.broken_documents(df).collect()) == ["", "[1]", "{broken"]


def test_bad_trades_are_set_aside(spark):
    df = docs(spark, {"E": 0, "s": "A", "p": "1"}, {"E": 0, "s": "A", "p": "x"}, {"E": 10**18, "s": "A", "p": "1"}, {"s": "A", "p": "1"}, "{}", "", "{x")
    assert payloads.flatten_trades(df).count() == 1
    assert payloads.rejected_trades(df).count() == 4


def test_post_payload(spark):
    post = {"id": "a", "title": 'Say "hi"\n', "score": 3, "created_utc": 1800000000.0, "url": "u"}
    df = payloads.flatten_posts(docs(spark, {"data": {"children": [{"data": post}, {"data": {"id": "b", "created_utc": "x"}}]}}, {"data": {}}))
    assert rows(df) == [("a", 'Say "hi"\n', "3", "2027-01-15 08:00:00", "u"), ("b", None, None, None, None)]


def test_trending_payload_skips_empty_items(spark):
    item = {"id": "a", "name": "A", "symbol": "AA", "market_cap_rank": None, "score": 0}
    df = payloads.flatten_trending(docs(spark, {"coins": [{"item": item}, {"item": {}}, {}, {"item": None}]}), fetched_at=at())
    assert rows(df) == [("a", "A", "AA", None, "0", "2024-01-05 10:00:00", "2024-01-05")]
    unknown = payloads.flatten_trending(docs(spark, {"coins": [{"item": {"id": None, "x": 1}}]}), fetched_at=at())
    assert rows(unknown.select("coin_id")) == [(None,)]


def test_trades_skip_empty_messages(spark):
    df = payloads.flatten_trades(docs(spark, {"E": 1704067200999, "s": "BTCUSDT", "p": "42000.5"}, "{}", ""))
    assert [(str(r.event_time), r.symbol, r.price) for r in df.collect()] == [("2024-01-01 00:00:00", "BTCUSDT", 42000.5)]


def test_fallback_only_when_empty(spark):
    fallback = payloads.fallback_posts(spark, at())
    empty = fallback.limit(0)
    assert [r.id for r in payloads.or_fallback(empty, fallback).orderBy("id").collect()] == [
        "fallback-bitcoin-20240105",
        "fallback-ethereum-20240105",
    ]
    some = fallback.withColumn("id", F.lit("x")).limit(1)
    assert [r.id for r in payloads.or_fallback(some, fallback).collect()] == ["x"]


def expand(glob):
    """Brace alternatives of a pattern without other wildcards."""
    start = glob.find("{")
    if start < 0:
        return {glob}
    depth, parts, last = 0, [], start + 1
    for i in range(start, len(glob)):
        if glob[i] == "{":
            depth += 1
        elif glob[i] == "," and depth == 1:
            parts.append(glob[last:i])
            last = i + 1
        elif glob[i] == "}":
            depth -= 1
            if depth == 0:
                parts.append(glob[last:i])
                return {x for p in parts for x in expand(glob[:start] + p + glob[i + 1 :])}
    raise AssertionError(glob)


@given(st.dates(dt.date(2020, 1, 1), dt.date(2026, 12, 31)), st.integers(0, 400))
@settings(max_examples=40, deadline=None)
def test_day_globs_name_exactly_the_range(start, days):
    wanted = {start + dt.timedelta(days=i) for i in range(days + 1)}
    got = expand(lake.day_folders(start, start + dt.timedelta(days=days)))
    assert got == {f"{d}" for d in wanted} | {f"dt={d}" for d in wanted}


def test_compaction_lists_no_permissions_and_few_tasks(spark, tmp_path, monkeypatch):
    """Whether there is anything ends at the first file, and named files are listed by a bounded number of tasks."""
    for i in range(90):
        write(tmp_path / f"raw/a{i % 3}/odd #{i} é%.json", json.dumps([json.loads(line(f"s{i}", 1.0))], indent=1))
    seen = []
    monkeypatch.setattr(sinks, "files_below", lambda *a: (seen.append(f) or f for f in session.files_below(*a)))
    assert sinks.holds_bytes(spark, str(tmp_path / "raw"), "*.json*") and len(seen) == 1
    assert not sinks.holds_bytes(spark, str(tmp_path / "raw"), "*.parquet") and len(seen) == 91
    spark.sparkContext.setJobGroup("by-name", "files by name")
    monkeypatch.setattr(lake, "LISTING_TASKS", 7)
    assert lake.read_mixed_json(spark, str(tmp_path / "raw"), PRICES).count() == 90
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("by-name") for s in tracker.getJobInfo(j).stageIds]
    tasks = [s.numTasks for s in stages if s]
    assert 7 in tasks and max(tasks) < 90

import json
import os

from helpers import rows
from pyspark.sql import types as T

from tickloom.operators import quality as Q
from tickloom.plans import marts, staging
from tickloom.sources import payloads
from tickloom.streaming import trades

TEXT = T.StructType([T.StructField("value", T.StringType())])
HOUR = 3600_000
T0 = 1704067200_000
landed = 0


def land(folder, name, messages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(m) if m else "" for m in messages))
    # Files are taken in order of modification time; make that the order of landing.
    global landed
    landed += 1
    os.utime(folder / name, (1_700_000_000 + landed, 1_700_000_000 + landed))


def ticks(spark, folder, **kw):
    return payloads.flatten_trades(trades.file_stream(spark, str(folder), TEXT, "text", **kw), "value")


def msg(hours, price, symbol="BTCUSDT"):
    return {"E": T0 + int(hours * HOUR), "s": symbol, "p": str(price)}


def test_append_is_exactly_once_across_restarts(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(src, "a.txt", [msg(0, 1.5), None, {}, msg(0, 1.5)])
    trades.append_sink(ticks(spark, src), out, state).awaitTermination()
    trades.append_sink(ticks(spark, src), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    land(src, "b.txt", [msg(1, 2.5)])
    trades.append_sink(ticks(spark, src), out, state).awaitTermination()
    got = [(str(t), s, p) for t, s, p in rows(spark.read.parquet(out))]
    assert got == [("2024-01-01 00:00:00", "BTCUSDT", 1.5)] * 2 + [("2024-01-01 01:00:00", "BTCUSDT", 2.5)]


def test_closed_days_equal_the_batch_mart(spark, tmp_path):
    src = tmp_path / "in"
    days = [[msg(24 * d + h, 10 * d + h % 3, s) for h in range(24) for s in ("A", "B") for _ in range(2)] for d in range(6)]
    for i, messages in enumerate(days):
        land(src, f"{i}.txt", messages + [msg(24 * i + 5, 99, "A")])
    stream = trades.closed_daily_average(ticks(spark, src, max_files=1), "1 day")
    trades.append_sink(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")).select("report_date", "coin_id", "avg_price"))

    batch = payloads.flatten_trades(spark.read.text(str(src)), "value").withColumnRenamed("event_time", "timestamp")
    daily = marts.daily_price(staging.stage_prices(batch))
    closed = daily.where("report_date < date'2024-01-05'").selectExpr("report_date", "upper(coin_id)", "avg_price")
    assert got == rows(closed) and len(got) == 8


def test_highest_copy_wins_in_closed_ticks(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.txt", [msg(0, 1), msg(0, 3), msg(0, 2), msg(80, 5)])
    trades.append_sink(trades.closed_ticks(ticks(spark, src)), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [r.price for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [3.0]


def test_copies_are_combined_before_the_state_shuffle(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.txt", [msg(0, 1), msg(80, 5)])
    q = trades.append_sink(trades.closed_ticks(ticks(spark, src)), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    below_exchange = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_max(price" in below_exchange


def test_freshness_of_the_sink(spark, tmp_path):
    from pyspark.sql import functions as F

    src = tmp_path / "in"
    land(src, "a.txt", [msg(0, 1), msg(1, 1)])
    trades.append_sink(ticks(spark, src), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    sink = spark.read.parquet(str(tmp_path / "out"))
    assert Q.freshness(sink, as_of=F.lit("2024-01-01 01:05:00").cast("timestamp")).first().status == "fresh"
    assert Q.freshness(sink, as_of=F.lit("2024-01-01 01:15:00").cast("timestamp")).first().status == "delayed"


def test_bad_messages_and_ticks_come_from_one_scan_and_a_batch_run_again_adds_nothing(spark, tmp_path):
    src, out, bad, state = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/bad", f"{tmp_path}/state"
    land(src, "a.txt", [msg(0, 1.5), None, {}, msg(1, "n/a")])
    stream = trades.file_stream(spark, str(src), TEXT, "text")
    query = trades.append_ticks(stream, "value", out, bad, state)
    query.awaitTermination()
    assert len(query.recentProgress) == 1 and query.lastProgress.sources[0].numInputRows == 4
    count = lambda: (spark.read.parquet(out).count(), spark.read.parquet(bad).count())
    assert count() == (1, 1)
    # The batch was landed, but its commit was lost: it runs again.
    for name in os.listdir(f"{state}/commits"):
        os.rename(f"{state}/commits/{name}", f"{tmp_path}/{name}")
    land(src, "b.txt", [msg(2, 2.5), msg(3, "n/a")])
    trades.append_ticks(trades.file_stream(spark, str(src), TEXT, "text"), "value", out, bad, state).awaitTermination()
    assert count() == (2, 2)


def follow(spark, tmp_path, averages):
    query = averages.start(ticks(spark, tmp_path / "in"), f"{tmp_path}/state")
    query.awaitTermination()
    got = rows(averages.averages(spark).selectExpr("string(report_date)", "coin_id", "avg_price"))
    late = rows(averages.progress(spark).select("batch", "late", "open_from"), "batch")
    return got, [(b, n, str(d)) for b, n, d in late]


def test_late_ticks_are_counted_and_correct_their_day(spark, tmp_path):
    averages = trades.DailyAverages(f"{tmp_path}/out", "1 day")
    src = tmp_path / "in"
    land(src, "a.txt", [msg(1, 10, "A"), msg(2, 20, "A"), msg(26, 5, "B"), msg(60, 1, "A")])
    got, late = follow(spark, tmp_path, averages)
    assert got == [("2024-01-01", "A", 15.0)] and late == [(0, 0, "2024-01-02")]
    land(src, "b.txt", [msg(3, 60, "A"), msg(2, 40, "A"), msg(30, 15, "B"), msg(90, 1, "A")])
    got, late = follow(spark, tmp_path, averages)
    assert got == [("2024-01-01", "A", (10 + 40 + 60) / 3), ("2024-01-02", "B", 10.0)]
    assert late == [(0, 0, "2024-01-02"), (1, 2, "2024-01-03")]
    land(src, "c.txt", [msg(5, 2, "C")])  # no time passes, and a closed day grows by a symbol
    got, late = follow(spark, tmp_path, averages)
    assert ("2024-01-01", "C", 2.0) in got and late[-1] == (2, 1, "2024-01-03") and len(got) == 3


def test_a_batch_of_averages_run_again_changes_nothing(spark, tmp_path):
    averages = trades.DailyAverages(f"{tmp_path}/out", "1 day")
    src = tmp_path / "in"
    land(src, "a.txt", [msg(1, 10, "A"), msg(60, 1, "A")])
    follow(spark, tmp_path, averages)
    land(src, "b.txt", [msg(2, 30, "A"), None, msg(61, 1, "A")])
    first = follow(spark, tmp_path, averages)
    batch = payloads.flatten_trades(spark.read.text(f"{src}/b.txt"), "value")
    averages.land(batch, 1)
    got = rows(averages.averages(spark).selectExpr("string(report_date)", "coin_id", "avg_price"))
    assert (got, 1) == (first[0], averages.progress(spark).where("batch = 1").first()["late"])
    assert averages.ticks(spark).count() == 4
    averages.land(batch.limit(0), 2)
    assert rows(averages.averages(spark).selectExpr("string(report_date)", "coin_id", "avg_price")) == got

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from meterlens.plans import alerts
from meterlens.streaming.backup import (
    copy_differences, daily_counts, late_rows, run_to_end, stream_backup,
)
from meterlens.streaming.batches import keep_late, streaming_session
from meterlens.streaming.failures import failure_stream

TASKS = (
    "name string, database_name string, schema_name string, state string, error_message string, "
    "query_start_time timestamp_ntz, event_id bigint"
)
NOW = dt.datetime(2024, 1, 30, 13, 0, 0)


def task(minutes_ago, state="FAILED", error="boom", event=0):
    return ("T", "D", "S", state, error, NOW - dt.timedelta(minutes=minutes_ago), event)


def test_no_failed_task(frame):
    df = frame(TASKS, task(5, "SUCCEEDED"), task(61))
    assert rows(alerts.failure_digest(df, NOW)) == [
        (1, 0, "<p>No task failures found in the past hour.</p>")
    ]
    assert rows(alerts.has_failures(df, NOW)) == [(False,)]


def test_digest_orders_rows_and_shortens_errors(frame):
    df = frame(TASKS, task(0, event=3), task(60, error="e" * 150, event=1), task(-1), task(5, error=None))
    ((page, failures, html),) = rows(alerts.failure_digest(df, NOW))
    assert (page, failures) == (1, 3)
    assert "<td></td>" in html
    assert html.startswith("<p>The following tasks have failed") and html.endswith("</table>")
    assert "<td>" + "e" * 100 + "</td>" in html
    assert html.index("2024-01-30 12:00:00") < html.index("2024-01-30 13:00:00")
    assert rows(alerts.has_failures(df, NOW)) == [(True,)]


def test_a_flood_of_failures_fills_several_pages(frame):
    df = frame(TASKS, *(task(i % 50, error=f"e{i}", event=i) for i in range(25)))
    pages = rows(alerts.failure_digest(df, NOW, page_rows=10))
    assert [p[:2] for p in pages] == [(1, 10), (2, 10), (3, 5)]
    assert all(sum(f"<td>e{i}</td>" in p[2] for p in pages) == 1 for i in range(25))


def _stream_of(spark, df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def test_streamed_failures_equal_the_batch_below_the_watermark(spark, frame, tmp_path):
    df = frame(TASKS, *(task(m, "FAILED" if m % 7 == 0 else "OK", event=m) for m in range(0, 300, 3)))
    stream = failure_stream(_stream_of(spark, df, str(tmp_path / "in")))
    run_to_end(stream, str(tmp_path / "out"))
    final = F.col("window_end") <= F.lit(NOW - dt.timedelta(minutes=10)).cast("timestamp_ntz")
    expected = rows(failure_stream(df).where(final), "window_start")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "window_start") == expected
    assert len(expected) > 200


def test_stream_backup_copies_all_and_reports_late_rows(spark, frame, at, tmp_path):
    folder, dest = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id int, t timestamp_ntz"
    first = frame(schema, (1, at("2024-01-01 05:00:00")), (2, at("2024-01-10 05:00:00")))
    stream = _stream_of(spark, first, folder)
    run = stream_backup(stream, dest, "t")
    assert late_rows(spark, run, "t").count() == 0
    assert [(str(d), n) for d, n in rows(spark.read.parquet(run.counts))] == [("2024-01-01", 1)]
    late = frame(schema, (3, at("2024-01-01 06:00:00")), (4, at("2024-01-08 06:00:00")),
                 (5, at("2024-01-20 06:00:00")))
    late.coalesce(1).write.mode("append").parquet(folder)
    run = stream_backup(stream, dest, "t")
    assert [(str(d), n) for d, n in rows(late_rows(spark, run, "t"))] == [("2024-01-01", 1)]
    assert spark.read.parquet(run.copy).count() == 5
    assert [(str(d), n) for d, n in rows(spark.read.parquet(run.counts), "run_date")] == [
        ("2024-01-01", 1), ("2024-01-08", 1), ("2024-01-10", 1)
    ]


def test_daily_counts_equal_the_batch_audit(spark, frame, at, tmp_path):
    df = frame("id int, t timestamp_ntz", *((i, at(f"2024-01-{1 + i % 20:02} 08:00:00")) for i in range(50)))
    stream = _stream_of(spark, df, str(tmp_path / "in"))
    run_to_end(daily_counts(stream, "t"), str(tmp_path / "out"))
    batch = df.groupBy(F.to_date("t").alias("d")).count().where("d <= date '2024-01-16'")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "run_date") == rows(batch, "d")


def test_results_do_not_depend_on_the_session_time_zone(spark, frame, tmp_path):
    df = frame(TASKS, task(0), task(60), task(61), task(-1))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert alerts.recent_failures(df, NOW).count() == 2
        windows = rows(failure_stream(df), "window_start")
        assert windows[0][:2] == (NOW - dt.timedelta(minutes=120), NOW - dt.timedelta(minutes=60))
        assert "2024-01-30 12:00:00" in rows(alerts.failure_digest(df, NOW))[0][2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


LOG = "id int, t timestamp_ntz"


def _arrive(df, folder, parts):
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(folder)


def _read(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def test_backup_in_one_and_in_ten_batches(spark, frame, at, tmp_path):
    df = frame(LOG, *((i, at(f"2024-01-{1 + i // 3:02} 08:00:00")) for i in range(60)), (99, None))
    folder = str(tmp_path / "in")
    _arrive(df, folder, [f"id between {k} and {k + 5}" for k in range(0, 60, 6)] + ["id = 99"])
    found = []
    for files in (100, 1):
        run = stream_backup(_read(spark, folder, LOG, files), str(tmp_path / f"out-{files}"), "t")
        found.append((rows(spark.read.parquet(run.counts), "run_date"), spark.read.parquet(run.copy).count()))
        assert copy_differences(spark, run, "t").isEmpty()
        assert late_rows(spark, run, "t").isEmpty()
    assert found[0] == found[1] and found[0][1] == 61 and len(found[0][0]) == 16


def test_a_repeated_batch_and_a_file_between_batches_change_nothing(spark, frame, at, tmp_path):
    df = frame(LOG, *((i, at(f"2024-01-{1 + i:02} 08:00:00")) for i in range(20)))
    folder, dest = str(tmp_path / "in"), str(tmp_path / "out")
    _arrive(df, folder, ["id < 5", "id between 5 and 9"])
    stream_backup(_read(spark, folder, LOG), dest, "t")
    # A crash after the second batch was written, before it was noted down.
    (tmp_path / "out/state/commits/1").unlink()
    (tmp_path / "out/state/commits/.1.crc").unlink(missing_ok=True)
    _arrive(df, folder, ["id >= 10"])
    run = stream_backup(_read(spark, folder, LOG), dest, "t")
    assert sorted(r.id for r in spark.read.parquet(run.copy).collect()) == list(range(20))
    assert [n for _, n in rows(spark.read.parquet(run.counts))] == [1] * 16
    assert copy_differences(spark, run, "t").isEmpty()


def test_differences_of_both_signs(spark, frame, at, tmp_path):
    df = frame(LOG, *((i, at(f"2024-01-{1 + i % 4:02} 08:00:00")) for i in range(8)))
    run = stream_backup(_stream_of(spark, df, str(tmp_path / "in")), str(tmp_path / "out"), "t")
    for part in (tmp_path / "out/copy/_day=2024-01-02").rglob("*.parquet"):
        part.unlink()
    extra = df.where("id = 2").selectExpr("id", "t", "0L _batch", "date'2024-01-03' _day")
    extra.write.mode("append").partitionBy("_day", "_batch").parquet(run.copy)
    found = [(str(d), n) for d, n in rows(copy_differences(spark, run, "t"), "run_date")]
    assert found == [("2024-01-02", -2), ("2024-01-03", 1)]


def test_a_backup_of_nothing_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = stream_backup(_read(spark, str(tmp_path / "in"), LOG), str(tmp_path / "out"), "t")
    assert spark.read.parquet(run.counts).count() == 0 and copy_differences(spark, run, "t").isEmpty()


def test_failures_in_batches_with_state_in_files_and_late_rows_kept(spark, frame, tmp_path):
    df = frame(TASKS, *(task(m) for m in range(300, 0, -7)), task(-90), task(280))
    own, folder = streaming_session(spark), str(tmp_path / "in")
    order = ["{0} >= timestamp'{1}' - interval 150 minutes and {0} <= timestamp'{1}'".format("query_start_time", NOW)]
    rest = f"not ({order[0]})"
    _arrive(df, folder, [*order, f"query_start_time > timestamp'{NOW}'", rest + f" and query_start_time <= timestamp'{NOW}'"])
    late = keep_late(_read(own, folder, df.schema), str(tmp_path / "late"), "query_start_time", "10 minutes")
    run_to_end(failure_stream(_read(own, folder, df.schema)), str(tmp_path / "out"))
    kept = df.where(order[0] + f" or query_start_time > timestamp'{NOW}'")
    final = F.col("window_end") <= F.lit(NOW + dt.timedelta(minutes=80)).cast("timestamp_ntz")
    expected = rows(failure_stream(kept).where(final), "window_start")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "window_start") == expected
    assert late.count() == df.where(rest + f" and query_start_time <= timestamp'{NOW}'").count() > 5

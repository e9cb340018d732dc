from meterlens.plans import alerts
from meterlens.sources.usage_logs import usage_log_stream
from meterlens.sources.workdir import work_folder
from meterlens.streaming.backup import run_to_end
from meterlens.streaming.batches import keep_late, streaming_session
from meterlens.streaming.failures import failure_stream
from registry.base import EVENTS_NOW, oracle, plain_types, report
from registry.ingest import arrived


def _stream(spark, folder):
    path = work_folder(spark, "failures")
    run_to_end(failure_stream(usage_log_stream(spark, folder, "task_history")), path)
    return plain_types(spark.read.parquet(path))


_IN_ORDER = [f"day(ts) between {day} and {day + 7}" for day in (1, 9, 17, 25)]


def _stream_in_batches(spark, folder):
    """As above, a file at a time, with the state in files."""
    own = streaming_session(spark)
    files = arrived(own, folder, "events", _IN_ORDER)
    path = work_folder(own, "failures")
    run_to_end(failure_stream(usage_log_stream(own, files, "task_history", files_per_batch=1)), path)
    return plain_types(spark.read.parquet(path))


def _late(spark, folder):
    """Failures that the stream leaves out because the older half arrives last."""
    files = arrived(spark, folder, "events", ["day(ts) >= 15", "day(ts) < 15"])
    stream = usage_log_stream(spark, files, "task_history", files_per_batch=1)
    late = keep_late(stream, work_folder(spark, "late"), "query_start_time", "10 minutes")
    return plain_types(late.where("state = 'FAILED'").select("event_id", "name", "query_start_time"))


QUERIES = {
    "a01_failure_digest": report(alerts.failure_digest, "task_history", now=EVENTS_NOW),
    "a02_has_failures": report(alerts.has_failures, "task_history", now=EVENTS_NOW),
    "a03_failure_stream": _stream,
    "a03_failure_stream_batches": _stream_in_batches,
    "a03_late_failures": _late,
}

_FAILED = """failed as (
select *, '<tr><td>' || coalesce(name, '') || '</td><td>' || coalesce(database_name, '')
  || '</td><td>' || coalesce(schema_name, '')
  || '</td><td>' || coalesce(left(error_message, 100), '') || '</td><td>'
  || strftime(query_start_time, '%Y-%m-%d %H:%M:%S') || '</td></tr>' as html
from task_history where state = 'FAILED'
  and query_start_time between timestamp '2024-01-30 12:00:00' and timestamp '2024-01-30 13:00:00')"""

_STREAMED = oracle("""
with minutes as (
  select date_trunc('minute', query_start_time) as minute, count(*) as failures
  from task_history where state = 'FAILED' group by 1),
windows as (
  select minute - interval 1 minute * k as window_start, failures
  from minutes, (select unnest(range(60)) as k) steps)
select strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start,
  strftime(window_start + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end,
  cast(sum(failures) as bigint) as failures
from windows
where window_start + interval 1 hour
  <= (select max(query_start_time) from task_history) - interval 10 minute
group by 1, 2""")

ORACLES = {
    "a01_failure_digest": oracle(f"""
with {_FAILED}
select cast(1 as bigint) as page, count(*) as failures,
  coalesce('<p>The following tasks have failed in the past hour:</p>'
    || '<table border="1" cellpadding="5" cellspacing="0" style="border-collapse: collapse;">'
    || '<tr><th>Task Name</th><th>Database</th><th>Schema</th><th>Error</th><th>Start Time</th></tr>'
    || string_agg(html, '' order by query_start_time, event_id) || '</table>',
    '<p>No task failures found in the past hour.</p>') as html
from failed"""),
    "a02_has_failures": oracle(f"""
with {_FAILED}
select count(*) > 0 as has_failures from failed"""),
    "a03_failure_stream": _STREAMED,
    "a03_failure_stream_batches": _STREAMED,
    "a03_late_failures": oracle("""
select event_id, name, strftime(query_start_time, '%Y-%m-%d %H:%M:%S') as query_start_time
from task_history where state = 'FAILED' and day(query_start_time) < 15
  and date_trunc('minute', query_start_time) + interval 1 minute
    <= (select max(query_start_time) from task_history where day(query_start_time) >= 15) - interval 10 minute"""),
}

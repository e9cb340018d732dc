import datetime as dt

from pyspark.sql import functions as F

from meterlens.functions.dates import moment
from meterlens.plans import ingest
from meterlens.sources import pages
from meterlens.sources.usage_logs import base_table, usage_log_stream
from meterlens.sources.workdir import work_folder
from meterlens.streaming.backup import copy_differences, stream_backup
from registry.base import ORDERS_AS_OF, oracle, plain_types, query, report

STARTED = dt.datetime(1998, 7, 1, 6, 0, 0)
PAGE_ROWS = 100
UNIT = "month"  # the test log has only a few rows a day


def _initial(log):
    history = log("query_history")
    dest = work_folder(history.sparkSession, "backup")
    return ingest.backup_initial(history, dest, "start_time", "query_history", STARTED, unit=UNIT)


def _delta(log):
    """A copy that ends in the middle of a day, brought up to date and tried again."""
    history = log("query_history")
    dest = work_folder(history.sparkSession, "backup")
    older = history.where(F.col("start_time") < moment(dt.datetime(1998, 6, 10, 12)))
    first = ingest.backup_initial(older, dest, "start_time", "query_history", STARTED, unit=UNIT)
    runs = [
        ingest.backup_delta(
            history, dest, "start_time", "query_history", ORDERS_AS_OF, STARTED, unit=UNIT
        )
        for _ in range(2)
    ]
    return first.unionByName(runs[0]).unionByName(runs[1])


def _purged(log):
    history = log("query_history")
    spark = history.sparkSession
    dest = work_folder(spark, "backup")
    ingest.backup_initial(history, dest, "start_time", "query_history", STARTED, unit=UNIT)
    purged = ingest.purge_older_than(spark, dest, "start_time", ORDERS_AS_OF)
    return purged.withColumn("kept", F.lit(spark.read.parquet(dest).count()))


def _pages(log):
    """Service pages saved as files, flattened, written as CSV and read back."""
    records = log("api_pages")
    spark = records.sparkSession
    body = F.expr("listagg(record_json, ',') within group (order by row_no)")
    listed = records.groupBy("endpoint", "page_no").agg(body.alias("body"))
    bare = F.concat(F.lit("["), "body", F.lit("]"))
    wrapped = F.concat(F.lit('{"results":['), "body", F.lit("]}"))
    payload = F.when(F.col("page_no") % 2 == 0, bare).otherwise(wrapped).alias("payload")
    folder = work_folder(spark, "pages")
    listed.select("endpoint", "page_no", payload).write.partitionBy("endpoint", "page_no").text(
        folder
    )
    flat = pages.flatten_pages(pages.read_saved_pages(spark, folder), "users", PAGE_ROWS)
    path = pages.write_endpoint_csv(flat, "/users/", work_folder(spark, "exports"))
    return spark.read.option("header", True).csv(path)


def _service_pages(log):
    """Pages of three endpoints with mixed records and of one without any; page 3 of the
    users cannot be read, and page 0 of a fifth endpoint is all it has."""
    records = log("service_records")
    spark = records.sparkSession
    body = F.expr("listagg(record_json, ',') within group (order by row_no)")
    listed = records.groupBy("endpoint", "page_no").agg(body.alias("body"))
    bare = F.concat(F.lit("["), "body", F.lit("]"))
    wrapped = F.concat(F.lit('{"results":['), "body", F.lit("]}"))
    broken = F.concat(F.lit('{"items":['), "body", F.lit("]}"))
    payload = F.when((F.col("endpoint") == "/users/v1/") & (F.col("page_no") == 3), broken)
    payload = payload.when(F.col("page_no") % 2 == 0, bare).otherwise(wrapped)
    others = spark.createDataFrame(
        [("/empty/v1/", 0, "[]"), ("/down/v1/", 0, "<html>busy</html>")],
        "endpoint string, page_no bigint, payload string",
    )
    return listed.select("endpoint", "page_no", payload.alias("payload")).unionByName(others)


def _export(log):
    pages_ = _service_pages(log)
    return pages.export_endpoints(pages_, work_folder(pages_.sparkSession, "exports"), 1)


def _exported_users(log):
    """The users' data set of an export of all endpoints, read back."""
    pages_ = _service_pages(log)
    folder = work_folder(pages_.sparkSession, "exports")
    pages.export_endpoints(pages_, folder, 1)
    exact = pages_.sparkSession.newSession()
    exact.conf.set("spark.sql.caseSensitive", "true")
    users = exact.read.option("header", True).csv(f"{folder}/users_v1.csv")
    renamed = {"K": "k_upper", "a.b": "a_b", "profile.segment": "segment", "profile.nation": "nation"}
    return users.toDF(*[renamed.get(c, c) for c in users.columns])


def _left_out(log):
    return pages.left_out(_service_pages(log), 1)


def _stored_audit(log):
    """A trial load, a load that is stored twice, and what the audit table then holds."""
    history = log("query_history")
    store = work_folder(history.sparkSession, "load-audit")
    arguments = {"column": "start_time", "table": "query_history"}
    for load, start in (("trial", STARTED), ("initial", STARTED), ("initial", STARTED)):
        audit = ingest.audit_rows(history, load_type=load, start_time=start, **arguments)
        ingest.store_audit(audit, store)
    delta = history.where(F.col("start_time") >= moment(dt.datetime(1998, 6, 1)))
    ingest.store_audit(
        ingest.audit_rows(delta, load_type="initial", start_time=STARTED + dt.timedelta(days=1), **arguments),
        store,
    )
    stored = history.sparkSession.read.parquet(store)
    return stored.groupBy("table_name", "load_type", F.col("load_id").cast("string").alias("load_id")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("row_count").alias("row_count")
    )


def _joined(spark, folder):
    names = base_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.concat(F.lit("order "), "o_orderkey").alias("name")
    )
    values = base_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value")
    )
    return plain_types(ingest.join_and_save(names, values, work_folder(spark, "joined")))


def arrived(spark, folder, table, conditions):
    """A folder with the base table as several files that arrive in the order given."""
    path = work_folder(spark, f"arriving-{table}")
    for condition in conditions:
        part = base_table(spark, folder, table).where(condition)
        part.coalesce(1).write.mode("append").parquet(f"{path}/{table}.parquet")
    return path


_IN_ORDER = [
    f"year(o_orderdate) between {first} and {last}"
    for first, last in ((1, 1995), (1996, 1997), (1998, 1999), (2000, 9999))
]


def _backup_in_batches(spark, folder, conditions):
    files = arrived(spark, folder, "orders", conditions)
    stream = usage_log_stream(spark, files, "query_history", files_per_batch=1)
    return stream_backup(stream, work_folder(spark, "stream-backup"), "start_time", unit=UNIT)


def _stream_in_batches(spark, folder):
    run = _backup_in_batches(spark, folder, _IN_ORDER)
    return plain_types(spark.read.parquet(run.counts))


def _stream_late(spark, folder):
    """The older half arrives last: its days are final by then."""
    run = _backup_in_batches(spark, folder, ["year(o_orderdate) >= 1996", "year(o_orderdate) < 1996"])
    days = spark.read.parquet(run.days_now)
    assert copy_differences(spark, run, "start_time").isEmpty()
    return plain_types(days.select("run_date", "row_count", "late_rows"))


def _stream(spark, folder):
    run = stream_backup(
        usage_log_stream(spark, folder, "query_history"), work_folder(spark, "stream-backup"),
        "start_time", unit=UNIT,
    )
    return plain_types(spark.read.parquet(run.counts))


QUERIES = {
    "i01_flatten_attributes": report(ingest.flatten_attributes, "attributes"),
    "i01_flatten_attributes_long": report(ingest.flatten_attributes_long, "attributes"),
    "i02_backup_initial": query(_initial),
    "i03_backup_delta": query(_delta),
    "i04_purge_older_than": query(_purged),
    "i05_flatten_pages": query(_pages),
    "i05_export_endpoints": query(_export),
    "i05_exported_users": query(_exported_users),
    "i05_left_out": query(_left_out),
    "i06_join_and_save": _joined,
    "i07_audit_rows": report(
        ingest.audit_rows, "query_history", column="start_time", table="query_history",
        load_type="initial", start_time=STARTED,
    ),
    "i07_store_audit": query(_stored_audit),
    "i08_stream_backup": _stream,
    "i08_stream_backup_batches": _stream_in_batches,
    "i08_stream_late_rows": _stream_late,
}


def _audit(load_type: str, where: str) -> str:
    return f"""select cast(start_time as date) as run_date, 'query_history' as table_name,
  '{load_type}' as load_type, '1998-07-01 06:00:00' as start_time, count(*) as row_count
from query_history where {where} group by 1"""


ORACLES = {
    "i01_flatten_attributes": oracle("""
select id, unnest(from_json(ids, '["varchar"]')) as individual_id,
  json_extract_string(attributes, '$.flag') as flag, json_extract_string(attributes, '$.k') as k,
  json_extract_string(attributes, '$.n') as n
from attributes"""),
    "i01_flatten_attributes_long": oracle("""
select id, unnest(from_json(ids, '["varchar"]')) as individual_id, key,
  json_extract_string(attributes, '$.' || key) as value
from (select id, ids, attributes, unnest(json_keys(attributes)) as key from attributes)"""),
    "i02_backup_initial": oracle(_audit("initial", "true")),
    "i03_backup_delta": oracle(
        _audit("initial", "start_time < timestamp '1998-06-10 12:00:00'")
        + " union all "
        + _audit(
            "delta",
            """start_time > (select max(start_time) from query_history
  where start_time < timestamp '1998-06-10 12:00:00')
  and cast(start_time as date) <= date '1998-06-28'""",
        )
    ),
    "i04_purge_older_than": oracle("""
select count(*) filter (where start_time < date '1995-06-28') as counted,
  count(*) filter (where start_time < date '1995-07-01') as deleted,
  count(*) filter (where start_time >= date '1995-07-01') as kept
from query_history"""),
    "i05_flatten_pages": """
select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as "profile.segment",
  cast(c_nationkey as varchar) as "profile.nation" from customer""",
    "i05_export_endpoints": oracle("""
with counted as (
  select endpoint, page_no, record_json, endpoint = '/users/v1/' and page_no = 3 as broken
  from service_records)
select endpoint, count(distinct case when not broken then page_no end) as pages,
  count(*) filter (where not broken and record_json like '{%') as records,
  count(*) filter (where not broken and record_json not like '{%') as skipped,
  count(distinct case when broken then page_no end) as unreadable,
  case endpoint when '/users/v1/' then 'users_v1.csv' when '/orders/v1/' then 'orders_v1.csv' end as file
from counted group by endpoint
union all select '/empty/v1/', 1, 0, 0, 0, null
union all select '/down/v1/', 0, 0, 0, 1, null"""),
    "i05_exported_users": oracle("""
select json_extract_string(record_json, '$.id') as id, json_extract_string(record_json, '$.name') as name,
  json_extract_string(record_json, '$.profile.segment') as segment,
  json_extract_string(record_json, '$.profile.nation') as nation,
  json_extract_string(record_json, '$.k') as k, json_extract_string(record_json, '$.K') as k_upper,
  coalesce(json_extract_string(record_json, '$.a.b'), json_extract_string(record_json, '$."a.b"')) as a_b
from service_records where endpoint = '/users/v1/' and page_no <> 3 and record_json like '{%'"""),
    "i05_left_out": oracle("""
select endpoint, page_no, position, 'no readable object' as reason, text from (
  select endpoint, page_no, record_json, case when record_json like '"%' then 'text' else record_json end as text,
    row_number() over (partition by endpoint, page_no order by row_no) - 1 as position
  from service_records where not (endpoint = '/users/v1/' and page_no = 3))
where record_json not like '{%'
union all
select '/users/v1/', 3, null, 'unreadable page', null
  where exists (from service_records where endpoint = '/users/v1/' and page_no = 3)
union all select '/down/v1/', 0, null, 'unreadable page', null"""),
    "i06_join_and_save": """
select o_custkey as id, 'order ' || cast(o_orderkey as varchar) as name, c_acctbal as value
from orders join customer on o_custkey = c_custkey""",
    "i07_audit_rows": oracle(_audit("initial", "true")),
    "i07_store_audit": oracle("""
select 'query_history' as table_name, load_type, load_id,
  count(distinct cast(start_time as date)) as days, count(*) as row_count
from query_history, (values ('trial', '19980701060000', date '1900-01-01'),
  ('initial', '19980701060000', date '1900-01-01'), ('initial', '19980702060000', date '1998-06-01'))
  loads(load_type, load_id, since)
where start_time >= since group by all"""),
    "i08_stream_backup_batches": oracle("""
select cast(start_time as date) as run_date, count(*) as row_count from query_history
group by 1
having cast(start_time as date) + interval 1 day
  <= (select max(start_time) from query_history) - interval 3 day"""),
    "i08_stream_late_rows": oracle("""
select cast(start_time as date) as run_date,
  count(*) filter (where year(start_time) >= 1996) as row_count,
  count(*) filter (where year(start_time) < 1996) as late_rows
from query_history group by 1"""),
    "i08_stream_backup": oracle("""
select cast(start_time as date) as run_date, count(*) as row_count from query_history
group by 1
having cast(start_time as date) + interval 1 day
  <= (select max(start_time) from query_history) - interval 3 day"""),
}

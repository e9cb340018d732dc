"""Usage-log tables derived from the base tables.

Each text runs unchanged on Spark and on an independent SQL engine, so both sides of
a check start from the same rows. On a real installation these are tables of the log
store, and the reports take them as plain DataFrames.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_TABLES = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"}

DERIVATIONS = {
    "query_history": """
select o_orderkey as query_id, o_orderdate as start_time,
  cast(floor(cast(o_totalprice as decimal(18,2))*10) as bigint) as total_elapsed_time,
  concat('U', cast(o_custkey % 50 as string)) as user_name,
  concat('R', cast(o_custkey % 5 as string)) as role_name,
  concat('WH_', cast(o_custkey % 10 as string)) as warehouse_name,
  o_orderpriority as query_type,
  case when o_orderstatus='F' then 'FAIL' else 'SUCCESS' end as execution_status,
  case when o_orderstatus='F' then cast(o_orderkey % 7 as int) end as error_code,
  case when o_orderstatus='F' then concat('error ', cast(o_orderkey % 7 as string)) end as error_message,
  case when o_orderkey % 23 = 0 then null else o_custkey % 200 end as query_parameterized_hash,
  case o_orderkey % 3
    when 0 then concat('MERGE INTO DB', cast(o_custkey % 4 as string), '.S', cast(o_custkey % 3 as string), '.T', cast(o_orderkey % 40 as string), ' USING SRC.X.Y ON 1=1')
    when 1 then concat('insert into DB1.S1.T', cast(o_orderkey % 40 as string), ' select * from SRC.X.T', cast(o_custkey % 20 as string), ' join D', cast(o_custkey % 5 as string), ' on 1=1')
    else concat('select 1 from my_table join DB2.S2.T', cast(o_custkey % 20 as string), ' using (id)') end as query_text,
  cast(o_orderkey % 11 as bigint) as rows_produced,
  cast(floor(cast(o_totalprice as decimal(18,2))) as bigint) as bytes_scanned,
  cast(o_orderkey % 5 as bigint) * 1000 as bytes_spilled_to_local_storage,
  cast(o_orderkey % 3 as bigint) * 1000 as bytes_spilled_to_remote_storage,
  cast(o_custkey % 9 as bigint) * 1000 as bytes_sent_over_the_network,
  case when o_orderkey % 13 = 0 then null else cast(o_orderkey % 100 as bigint) end as partitions_scanned,
  cast(100 as bigint) as partitions_total
from orders
""",
    "query_scripts": """
select o_orderkey as query_id, case o_orderkey % 7
    when 0 then concat('select *', chr(10), 'from DB', cast(o_custkey % 4 as string), '.S.T1', chr(10), 'where a = ', chr(39), 'x', chr(39))
    when 1 then concat('select * from (select 1 from A', cast(o_custkey % 9 as string), ', (select 2 from B.C6));')
    when 2 then concat('copy into DB1.S1.T', cast(o_custkey % 9 as string), ' from @stage/file.csv;')
    when 3 then concat('insert into T7; select 1 from ', chr(9), ' T8 join', chr(10), 'U', cast(o_custkey % 9 as string), ' on 1=1')
    when 4 then concat('select * from "My Table" join X.Y', cast(o_custkey % 9 as string), ')')
    when 5 then concat('select ', chr(39), 'from', chr(39), ' as word from Z1, Z2', chr(13), chr(10), 'join W', cast(o_custkey % 9 as string), ';', chr(10))
    else 'copy into (select 1)' end as query_text
from orders
""",
    "query_attribution_history": """
select l_orderkey as query_id, o_orderdate as start_time,
  cast(cast(l_extendedprice as decimal(18,2))/100 as decimal(18,4)) as credits_attributed_compute
from lineitem join orders on l_orderkey = o_orderkey where l_linenumber = 1
""",
    "query_operator_stats": """
select query_id, start_time, 1 as step_id,
  row_number() over (partition by query_id, start_time order by l_linenumber,l_partkey,l_suppkey,l_quantity,l_extendedprice,l_shipdate,l_discount,l_tax,l_returnflag,l_linestatus) as operator_id,
  case l_partkey % 4 when 0 then 'UnionAll' when 1 then 'Aggregate' when 2 then 'Join' else 'TableScan' end as operator_type,
  concat('{"input_rows":', cast(cast(floor(l_quantity) as int) - 1 as string),
    ',"output_rows":', cast(cast(l_suppkey % 50 as int) as string),
    ',"spilling":{"bytes_spilled_local_storage":', cast(case when l_suppkey % 7 = 0 then 1 else 0 end as string),
    ',"bytes_spilled_remote_storage":', cast(case when l_suppkey % 11 = 0 then 1 else 0 end as string),
    '},"pruning":{"partitions_scanned":', cast(cast(floor(l_quantity) as int)*1000 as string),
    ',"partitions_total":', cast(case when l_partkey % 9 = 0 then 0 else 50000 end as string), '}}') as operator_statistics
from (select l_orderkey as query_id, o_orderdate as start_time, l.* from lineitem l join orders o on l_orderkey = o_orderkey) q
""",
    "warehouse_metering_history": """
select concat('WH_', cast(user_id % 10 as string)) as warehouse_name,
  date_trunc('hour', ts) as start_time, date_trunc('hour', ts) + interval 1 hour as end_time,
  cast(sum(cast(value as decimal(18,2)))/100 as decimal(18,4)) as credits_used,
  cast(sum(cast(value as decimal(18,2)))/125 as decimal(18,4)) as credits_used_compute
from events group by concat('WH_', cast(user_id % 10 as string)), date_trunc('hour', ts)
""",
    "warehouse_credits": """
select concat('ACC_', cast(l_suppkey % 3 as string)) as account_name,
  case when l_suppkey % 10 = 8 then 'CLOUD_SERVICES_ONLY' when l_suppkey % 10 = 9 then null else concat('WH_', cast(l_suppkey % 10 as string)) end as warehouse_name,
  'WAREHOUSE_METERING' as service_type, l_shipdate as start_time,
  cast(l_quantity as decimal(18,2)) as credits_used,
  case when l_linenumber = 7 then null else cast(l_quantity as decimal(18,2)) end as credits_used_compute
from lineitem
""",
    "warehouse_load_history": """
select concat('WH_', cast(user_id % 10 as string)) as warehouse_name, ts as start_time, ts + interval 5 minutes as end_time,
  cast(cast(value as decimal(18,2))/1000 as decimal(18,6)) as avg_running,
  cast((user_id % 7)/100.0 as decimal(18,6)) as avg_queued_load,
  cast(0 as decimal(18,6)) as avg_queued_provisioning,
  cast((event_id % 3)/100.0 as decimal(18,6)) as avg_blocked,
  cast(value as decimal(18,2)) as execution_time
from events
""",
    "query_activity": """
select concat('WH_', cast(user_id % 10 as string)) as warehouse_name, ts as start_time, ts + interval 5 minutes as end_time, event_id as query_id
from events where event_type in ('view','purchase')
""",
    "warehouses": """
select concat('WH_', cast(s_suppkey as string)) as name,
  case s_suppkey % 4 when 0 then 'XSMALL' when 1 then 'SMALL' when 2 then 'MEDIUM' else 'LARGE' end as size
from supplier where s_suppkey < 7
""",
    "metering_history": """
select case l_partkey % 5 when 0 then 'WAREHOUSE_METERING' when 1 then 'SEARCH_OPTIMIZATION' when 2 then 'AUTO_CLUSTERING' when 3 then 'MATERIALIZED_VIEW' else 'PIPE' end as service_type,
  case l_partkey % 5 when 1 then concat('SEARCH OPTIMIZATION ON TABLE ID ', lpad(cast(l_partkey as string), 10, '0')) else concat('WH_', cast(l_suppkey % 10 as string)) end as name,
  l_partkey as entity_id, l_shipdate as start_time,
  cast(l_extendedprice as decimal(18,2)) as credits_used_compute,
  case when l_linenumber = 7 then null else cast(l_tax as decimal(18,2)) end as credits_used_cloud_services
from lineitem
""",
    "materialized_view_refresh_history": """
select concat('DB', cast(l_partkey % 4 as string)) as database_name, 'MATERIALIZED_VIEW' as service_type,
  l_shipdate as start_time, cast(l_quantity as decimal(18,2)) as credits_used
from lineitem where l_partkey % 5 = 3
""",
    "tables": """
select p_partkey as table_id, concat('DB', cast(p_partkey % 4 as string)) as table_catalog,
  concat('S', cast(p_partkey % 3 as string)) as table_schema, concat('T', cast(p_partkey as string)) as table_name,
  case when p_size % 10 = 0 then 'VIEW' else 'BASE TABLE' end as table_type,
  cast(p_size as bigint) as row_count, cast(floor(cast(p_retailprice as decimal(18,2))) as bigint) * 1000000 as bytes,
  case when p_partkey % 17 = 0 then timestamp '1998-01-01 00:00:00' end as deleted,
  timestamp '1997-01-01 00:00:00' + interval 1 day * cast(p_partkey % 700 as int) as last_altered,
  p_brand as table_owner, p_size % 8 as retention_time
from part
""",
    "access_history": """
select l_orderkey as query_id, concat('U', cast(o_custkey % 50 as string)) as user_name, o_orderdate as query_start_time,
  concat('[{"objectName":"DB', cast(l_partkey % 4 as string), '.S', cast(l_partkey % 3 as string), '.T', cast(l_partkey as string), '"}]') as base_objects_accessed
from lineitem join orders on l_orderkey = o_orderkey where l_linenumber <= 2 and l_partkey % 3 <> 0
""",
    "database_storage_usage_history": """
select concat('ACC_', cast(l_suppkey % 3 as string)) as account_name, concat('DB', cast(l_partkey % 4 as string)) as database_name,
  l_partkey % 4 as database_id, l_shipdate as usage_date,
  cast(floor(cast(l_extendedprice as decimal(18,2))) as bigint) * 100000000 as average_database_bytes,
  cast(floor(l_quantity) as bigint) * 10000000000 as average_failsafe_bytes,
  cast(l_linenumber as bigint) * 1000000000 as average_hybrid_table_storage_bytes
from lineitem
""",
    "table_storage_metrics": """
select p_partkey as id, concat('DB', cast(p_partkey % 4 as string)) as table_catalog, concat('S', cast(p_partkey % 3 as string)) as table_schema,
  concat('T', cast(p_partkey as string)) as table_name, (p_partkey % 17 = 0) as deleted,
  cast(floor(cast(p_retailprice as decimal(18,2))) as bigint) * 1000000000 as active_bytes,
  cast(p_size as bigint) * 1000000000 as failsafe_bytes, cast(p_size % 5 as bigint) * 1000000000 as time_travel_bytes
from part
""",
    "automatic_clustering_history": """
select l_partkey as table_id, concat('DB', cast(l_partkey % 4 as string)) as database_name, concat('S', cast(l_partkey % 3 as string)) as schema_name,
  concat('T', cast(l_partkey as string)) as table_name, l_shipdate as start_time, cast(l_quantity as decimal(18,2)) as credits_used
from lineitem where l_partkey % 5 = 2
""",
    "usage_in_currency_daily": """
select n_name as account_name, o_orderpriority as service_type, cast(o_orderdate as date) as usage_date,
  cast(o_totalprice as decimal(18,2)) as usage_in_currency
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""",
    "task_history": """
select concat('TASK_', cast(user_id % 10 as string)) as name, concat('DB', cast(user_id % 4 as string)) as database_name, 'S0' as schema_name,
  case when event_type='error' then 'FAILED' else 'SUCCEEDED' end as state,
  case when event_type='error' then concat('failure ', props) end as error_message, ts as query_start_time, event_id
from events
""",
    "wh_owner_xref": """
select 'ACC_0' as account_name, concat('WH_', cast(s_suppkey as string)) as wh_name, s_name as owner,
  case when s_suppkey % 2 = 0 then concat('APP', cast(s_nationkey as string)) end as application
from supplier where s_suppkey < 6
""",
    "tag_references": """
select 'TABLE' as domain, concat('DB', cast(p_partkey % 4 as string)) as object_database, concat('S', cast(p_partkey % 3 as string)) as object_schema,
  concat('T', cast(p_partkey as string)) as object_name, 'GOV' as tag_database, 'PUBLIC' as tag_schema,
  'DEPARTMENT' as tag_name, case p_size % 3 when 0 then 'finance' when 1 then 'transfers' else 'ops' end as tag_value
from part
union all
select 'TABLE', 'DB9', concat('S', cast(p_partkey % 3 as string)), concat('T', cast(p_partkey as string)), 'GOV', 'PUBLIC', 'DEPARTMENT', 'archive'
from part where p_size % 7 = 0
""",
    "comment_catalog": """
select concat('DB', cast(p_partkey % 4 as string)) as database_name, concat('S', cast(p_partkey % 3 as string)) as schema_name,
  concat('T', cast(p_partkey as string)) as table_name, concat('C', cast(p_size % 6 as string)) as column_name, p_name as comments
from part
""",
    "column_inventory": """
select concat('DB', cast(p_partkey % 4 as string)) as database_name, concat('S', cast(p_partkey % 3 as string)) as schema_name,
  concat('T', cast(p_partkey as string)) as table_name, concat('C', cast(p_size % 4 as string)) as column_name
from part
""",
    "attributes": """
select event_id as id, concat('[', cast(user_id as string), ',', cast(user_id + 1 as string), ']') as ids,
  case when event_type = 'error' then concat('{"k":', cast(user_id as string), ',"flag":true}')
       when event_type = 'view' then concat('{"k":"txt', cast(user_id % 5 as string), '","n":', cast(user_id as string), '}')
       else props end as attributes
from events
""",
    "api_pages": """
select 'users' as endpoint, cast(floor((c_custkey) / 100) as bigint) as page_no, c_custkey as row_no,
  concat('{"id":', cast(c_custkey as string), ',"name":"', c_name, '","profile":{"segment":"', c_mktsegment, '","nation":', cast(c_nationkey as string), '}}') as record_json
from customer
""",
    "container_tag_references": """
select domain, object_database, object_schema, object_name, tag_database, tag_schema, tag_name, tag_value
from (select 'TABLE' as domain, concat('DB', cast(p_partkey % 4 as string)) as object_database, concat('S', cast(p_partkey % 3 as string)) as object_schema,
  concat('T', cast(p_partkey as string)) as object_name, 'GOV' as tag_database, 'PUBLIC' as tag_schema,
  'DEPARTMENT' as tag_name, case p_size % 3 when 0 then 'finance' when 1 then 'transfers' else 'ops' end as tag_value
from part
union all
select 'TABLE', 'DB9', concat('S', cast(p_partkey % 3 as string)), concat('T', cast(p_partkey as string)), 'GOV', 'PUBLIC', 'DEPARTMENT', 'archive'
from part where p_size % 7 = 0
) tag_source where tag_value = 'finance'
union all
select 'SCHEMA', 'DB1', cast(null as string), concat('S', cast(r_regionkey as string)), 'GOV', 'PUBLIC', 'DEPARTMENT', concat('schema-', lower(r_name))
from region where r_regionkey < 2
union all
select 'DATABASE', cast(null as string), cast(null as string), concat('DB', cast(r_regionkey as string)), 'GOV', 'PUBLIC', 'DEPARTMENT', concat('database-', lower(r_name))
from region where r_regionkey in (1, 2)
union all
select 'WAREHOUSE', cast(null as string), cast(null as string), concat('WH_', cast(r_regionkey as string)), 'GOV', 'PUBLIC', 'DEPARTMENT', lower(r_name)
from region
union all
select 'ACCOUNT', cast(null as string), cast(null as string), 'ACC_0', 'GOV', 'PUBLIC', 'DEPARTMENT', lower(r_name)
from region where r_regionkey = 4
""",
    "credit_rates": """
select concat('ACC_', cast(r_regionkey as string)) as account_name, date '1990-01-01' as valid_from,
  case r_regionkey when 1 then date '1996-07-01' when 2 then date '1997-04-02' else date '1997-01-01' end as valid_to,
  cast(2.32 as decimal(6,2)) as price
from region where r_regionkey < 3
union all
select concat('ACC_', cast(r_regionkey as string)), date '1997-01-01', date '1999-01-01', cast(2.56 as decimal(6,2))
from region where r_regionkey < 3
union all
select concat('ACC_', cast(r_regionkey as string)), date '1999-01-01', cast(null as date), cast(3 + r_regionkey as decimal(6,2))
from region where r_regionkey < 3
""",
    "service_records": """
select '/users/v1/' as endpoint, cast(floor(c_custkey / 100) as bigint) as page_no, c_custkey as row_no,
  case c_custkey % 50 when 7 then '5' when 8 then '"text"' when 9 then '[1]' when 10 then 'null' else
  concat('{"id":', cast(c_custkey as string), ',"name":"', c_name, '","profile":{"segment":"', c_mktsegment, '","nation":', cast(c_nationkey as string), '}',
    case when c_custkey % 3 = 0 then concat(',"k":', cast(c_custkey % 10 as string), ',"K":"', c_mktsegment, '"') else '' end,
    case when c_custkey % 4 = 0 then concat(',"a.b":', cast(c_custkey as string)) else '' end,
    case when c_custkey % 6 = 0 then concat(',"a":{"b":', cast(c_custkey + 1 as string), '}') else '' end, '}') end as record_json
from customer
union all
select '/orders/v1/', cast(floor(o_orderkey / 400) as bigint), o_orderkey,
  concat('{"order":', cast(o_orderkey as string), ',"priority":"', o_orderpriority, '","lines":[', cast(o_orderkey % 7 as string), ',2]}')
from orders
union all
select '/odd/', n_nationkey, n_nationkey, cast(n_nationkey as string) from nation
""",
}


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def inputs_of(name: str) -> list[str]:
    """Base tables a derivation reads."""
    return sorted(set(re.findall(r"\b(?:from|join)\s+(\w+)", DERIVATIONS[name])) & BASE_TABLES)


def usage_log(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One derived table; zoned timestamps become zone-less like all others."""
    reads = (f"{t} as (select * from parquet.`{folder}/{t}.parquet`)" for t in inputs_of(name))
    table = spark.sql(f"with {', '.join(reads)} {DERIVATIONS[name]}")
    zoned = [f.name for f in table.schema if isinstance(f.dataType, T.TimestampType)]
    return table.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def usage_log_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """A derived table as a stream over the files of its single base table."""
    (table,) = inputs_of(name)
    # A pattern, so that the table may be one file or a folder of files.
    reader = spark.readStream.schema(base_table(spark, folder, table).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.parquet(f"{folder}/{table}.parquet*")
    derived = DERIVATIONS[name].replace(f"from {table}", f"from {{{table}}}")
    return spark.sql(derived, **{table: files})

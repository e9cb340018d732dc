import datetime as dt

from pyspark.sql import functions as F

from meterlens.plans import governance
from meterlens.sources.usage_logs import base_table
from registry.base import ORDERS_AS_OF, oracle, plain_types, query, report

CHANGED_AT = dt.datetime(1998, 7, 1, 6, 0, 0)


def _outcomes(inventory):
    """Attempts on all but some tables, of which some fail."""
    return inventory.where(F.col("row_count") % 7 != 0).select(
        *governance.TABLE_KEY, (F.col("row_count") % 5 != 0).alias("succeeded")
    )


def _outcome(plan):
    def run(log):
        inventory = governance.retention_inventory(log("tables"))
        return plan(inventory, _outcomes(inventory), CHANGED_AT)

    return query(run)


def _masked(spark, folder):
    tags = spark.createDataFrame(
        [("c_name", "security_class", "PII"), ("c_acctbal", "security_class", "OPEN")],
        "column_name string, tag_name string, tag_value string",
    )
    return plain_types(governance.mask_by_tag(base_table(spark, folder, "customer"), tags))


QUERIES = {
    "g01_unused_tables": report(
        governance.unused_tables, "tables", "access_history", as_of=ORDERS_AS_OF
    ),
    "g02_retention_inventory": report(governance.retention_inventory, "tables"),
    "g02_retention_inventory_all": report(
        governance.retention_inventory, "tables", min_days=None
    ),
    "g03_apply_retention_outcome": _outcome(governance.apply_retention_outcome),
    "g03_retention_audit": _outcome(governance.retention_audit),
    "g04_comment_plan": report(governance.comment_plan, "comment_catalog", "column_inventory"),
    "g05_tagged_objects": report(
        governance.tagged_objects, "tag_references", db="GOV", schema="PUBLIC",
        name="DEPARTMENT", value="finance",
    ),
    "g06_mask_by_tag": _masked,
    "g07_cost_by_tag": report(
        governance.cost_by_tag, "access_history", "query_history", "query_attribution_history",
        "tag_references", as_of=ORDERS_AS_OF, days=179,
    ),
    "g07_cost_by_tag_all": report(
        governance.cost_by_tag, "access_history", "query_history", "query_attribution_history",
        "tag_references",
    ),
    "g07_cost_by_inherited_tag": report(
        governance.cost_by_inherited_tag, "access_history", "query_history",
        "query_attribution_history", "container_tag_references",
    ),
}

_INVENTORY = """
select table_catalog, table_schema, table_name, bytes as storage_bytes, row_count,
  table_owner as owner, cast(coalesce(retention_time, 0) as bigint) as current_time_travel_duration,
  'Y' as change_tt, cast(null as varchar) as last_updated, '' as comments
from tables where deleted is null"""

ORACLES = {
    "g01_unused_tables": oracle("""
with objects as (
  select unnest(from_json(base_objects_accessed, '["json"]')) as object
  from access_history
  where query_start_time >= date '1998-01-03' and query_start_time < date '1998-07-02'),
used as (
  select distinct split_part(name, '.', 1) as c, split_part(name, '.', 2) as s,
    split_part(name, '.', 3) as t
  from (select json_extract_string(object, '$.objectName') as name from objects) n)
select table_catalog, table_schema, table_name, row_count,
  cast(bytes as double) / 1000 / 1000 as size_in_mb,
  strftime(last_altered, '%Y-%m-%d %H:%M:%S') as last_altered, table_owner
from tables left join used on c = table_catalog and s = table_schema and t = table_name
where t is null and deleted is null and table_type = 'BASE TABLE'
  and last_altered < date '1998-01-02'"""),
    "g02_retention_inventory": oracle(f"{_INVENTORY} and retention_time > 3"),
    "g02_retention_inventory_all": oracle(_INVENTORY),
    "g03_apply_retention_outcome": oracle(f"""
with inventory as ({_INVENTORY} and retention_time > 3)
select table_catalog, table_schema, table_name, storage_bytes, row_count, owner,
  case when row_count % 7 <> 0 and row_count % 5 <> 0 then 3
    else current_time_travel_duration end as current_time_travel_duration,
  case when row_count % 7 <> 0 and row_count % 5 <> 0 then 'N' else 'Y' end as change_tt,
  case when row_count % 7 <> 0 then '1998-07-01 06:00:00' end as last_updated,
  case when row_count % 7 = 0 then '' when row_count % 5 <> 0 then 'Time Travel Duration Changed'
    else 'Failed to Change Time Travel Duration' end as comments
from inventory"""),
    "g03_retention_audit": oracle(f"""
with inventory as ({_INVENTORY} and retention_time > 3)
select table_catalog, table_schema, table_name, row_count, owner,
  current_time_travel_duration as time_travel_duration, '1998-07-01 06:00:00' as last_updated,
  case when row_count % 5 <> 0 then 'Time Travel Duration Changed to 3 Days'
    else 'Failed to Change Time Travel Duration' end as comments
from inventory where row_count % 7 <> 0"""),
    "g04_comment_plan": oracle("""
select c.database_name, c.schema_name, c.table_name, c.column_name,
  case when k.column_name is null then 'failed' else 'apply' end as status,
  case when k.column_name is not null then
    'ALTER TABLE ' || c.database_name || '.' || c.schema_name || '.' || c.table_name
    || ' ALTER COLUMN ' || c.column_name || ' comment ''' || replace(comments, '''', '''''') || ''''
  end as statement
from comment_catalog c left join (select distinct * from column_inventory) k
  on c.database_name = k.database_name and c.schema_name = k.schema_name
  and c.table_name = k.table_name and c.column_name = k.column_name"""),
    "g05_tagged_objects": oracle("""
select domain, object_name from tag_references
where tag_database = 'GOV' and tag_schema = 'PUBLIC' and tag_name = 'DEPARTMENT'
  and tag_value = 'finance'"""),
    "g06_mask_by_tag": """
select c_custkey, '**Masked**' as c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal,
  c_mktsegment from customer""",
    "g07_cost_by_tag": oracle("""
with objects as (
  select distinct query_id, json_extract_string(object, '$.objectName') as name
  from (select query_id, unnest(from_json(base_objects_accessed, '["json"]')) as object
        from access_history
        where query_start_time >= date '1998-01-03' and query_start_time < date '1998-07-02') o),
spread as (select query_id, count(*) as objects from objects group by 1),
credited as (
  select query_id, sum(credits_attributed_compute) as credits
  from query_attribution_history
  where start_time >= date '1998-01-03' and start_time < date '1998-07-02' group by 1),
shares as (
  select name, warehouse_name, user_name,
    cast(round(cast(credits as double) / objects, 8) as decimal(28,8)) as share
  from objects join spread using (query_id) join query_history using (query_id)
  join credited using (query_id)
  where start_time >= date '1998-01-03' and start_time < date '1998-07-02')
select tag_value, object_database, object_schema, object_name, warehouse_name, user_name,
  cast(sum(share) as double) as credits, count(*) as object_uses
from shares join tag_references
  on name = object_database || '.' || object_schema || '.' || object_name
where tag_name = 'DEPARTMENT' and domain = 'TABLE' group by 1, 2, 3, 4, 5, 6"""),
    "g07_cost_by_tag_all": oracle("""
with objects as (
  select distinct query_id, json_extract_string(object, '$.objectName') as name
  from (select query_id, unnest(from_json(base_objects_accessed, '["json"]')) as object
        from access_history) o),
spread as (select query_id, count(*) as objects from objects group by 1),
credited as (
  select query_id, sum(credits_attributed_compute) as credits
  from query_attribution_history group by 1),
shares as (
  select name, warehouse_name, user_name,
    cast(round(cast(credits as double) / objects, 8) as decimal(28,8)) as share
  from objects join spread using (query_id) join query_history using (query_id)
  join credited using (query_id))
select tag_value, object_database, object_schema, object_name, warehouse_name, user_name,
  cast(sum(share) as double) as credits, count(*) as object_uses
from shares join tag_references
  on name = object_database || '.' || object_schema || '.' || object_name
where tag_name = 'DEPARTMENT' and domain = 'TABLE' group by 1, 2, 3, 4, 5, 6"""),
    "g07_cost_by_inherited_tag": oracle("""
with objects as (
  select distinct query_id, json_extract_string(object, '$.objectName') as name
  from (select query_id, unnest(from_json(base_objects_accessed, '["json"]')) as object
        from access_history) o),
spread as (select query_id, count(*) as objects from objects group by 1),
credited as (
  select query_id, sum(credits_attributed_compute) as credits
  from query_attribution_history group by 1),
shares as (
  select split_part(name, '.', 1) as d, split_part(name, '.', 2) as s, split_part(name, '.', 3) as t,
    warehouse_name, user_name, cast(round(cast(credits as double) / objects, 8) as decimal(28,8)) as share
  from objects join spread using (query_id) join query_history using (query_id)
  join credited using (query_id)),
tags as (select * from container_tag_references where tag_name = 'DEPARTMENT'),
resolved as (
  select user_name, share,
    (select min(tag_value) from tags where domain = 'TABLE' and object_database = d
      and object_schema = s and object_name = t) as by_table,
    (select min(tag_value) from tags where domain = 'SCHEMA' and object_database = d
      and object_name = s) as by_schema,
    (select min(tag_value) from tags where domain = 'DATABASE' and object_name = d) as by_database,
    (select min(tag_value) from tags where domain = 'ACCOUNT') as by_account,
    (select min(tag_value) from tags where domain = 'WAREHOUSE' and object_name = warehouse_name)
      as warehouse_tag
  from shares)
select coalesce(by_table, by_schema, by_database, by_account) as tag_value,
  case when by_table is not null then 'table' when by_schema is not null then 'schema'
    when by_database is not null then 'database' when by_account is not null then 'account' end as tag_level,
  warehouse_tag, user_name, cast(sum(share) as double) as credits, count(*) as object_uses
from resolved group by all"""),
}

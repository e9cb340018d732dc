import pytest
from conftest import plan, rows

from meterlens.plans import governance as g

TABLES = (
    "table_catalog string, table_schema string, table_name string, table_type string, "
    "row_count bigint, bytes bigint, deleted timestamp_ntz, last_altered timestamp_ntz, "
    "table_owner string, retention_time int"
)


@pytest.fixture
def tables(frame, at):
    old = at("1997-01-01 00:00:00")
    return frame(
        TABLES, ("D", "S", "UNUSED", "BASE TABLE", 1, 2_000_000, None, old, "o", 4),
        ("D", "S", "USED", "BASE TABLE", 1, 1, None, old, "o", 3),
        ("D", "S", "VIEW", "VIEW", 1, 1, None, old, "o", 9),
        ("D", "S", "GONE", "BASE TABLE", 1, 1, old, old, "o", 9),
        ("D", "S", "FRESH", "BASE TABLE", 1, 1, None, at("1998-01-02 00:00:00"), "o", None),
        ("E", "S", "EDGE", "BASE TABLE", 1, 1, None, at("1998-01-01 23:59:59"), "o", 1),
    )


def access(frame, at, *entries):
    return frame(
        "query_id bigint, user_name string, query_start_time timestamp_ntz, "
        "base_objects_accessed string",
        *((i, "u", at(when), objects) for i, (when, objects) in enumerate(entries)),
    )


def test_unused_tables(frame, at, tables):
    log = access(
        frame, at, ("1998-06-01 00:00:00", '[{"objectName":"D.S.USED"},{"objectName":"SHORT"}]'),
        ("1998-01-02 12:00:00", '[{"objectName":"D.S.UNUSED"}]'), ("1998-06-01 00:00:00", None),
    )
    found = g.unused_tables(tables, log, "1998-07-01")
    assert [(r.table_name, r.size_in_mb) for r in found.collect()] == [
        ("UNUSED", 2.0), ("EDGE", 0.000001)
    ]
    assert "CartesianProduct" not in plan(found)


def test_retention(frame, at, tables):
    inventory = g.retention_inventory(tables)
    assert [r.table_name for r in inventory.collect()] == ["UNUSED", "VIEW"]
    everything = g.retention_inventory(tables, None, exclude_like="%E%")
    assert {r.table_name: r.current_time_travel_duration for r in everything.collect()} == {
        "UNUSED": 4, "USED": 3, "VIEW": 9, "FRESH": 0
    }
    outcomes = frame(
        "table_catalog string, table_schema string, table_name string, succeeded boolean",
        ("D", "S", "UNUSED", True), ("D", "S", "VIEW", False), ("D", "S", "OTHER", True),
    )
    now = at("1998-07-01 06:00:00")
    changed = {r.table_name: r for r in g.apply_retention_outcome(inventory, outcomes, now).collect()}
    assert (changed["UNUSED"].change_tt, changed["UNUSED"].current_time_travel_duration,
            changed["UNUSED"].comments) == ("N", 3, "Time Travel Duration Changed")
    assert (changed["VIEW"].change_tt, changed["VIEW"].current_time_travel_duration,
            changed["VIEW"].last_updated) == ("Y", 9, now)
    again = g.apply_retention_outcome(
        g.apply_retention_outcome(inventory, outcomes, now), outcomes, at("1999-01-01 00:00:00")
    )
    assert {r.table_name: r.last_updated.year for r in again.collect()} == {"UNUSED": 1998, "VIEW": 1999}
    assert g.retention_audit(inventory, outcomes, now).count() == 2


def test_comments_escape_quotes_and_need_a_known_column(frame):
    catalog = frame(
        "database_name string, schema_name string, table_name string, column_name string, "
        "comments string",
        ("D", "S", "T", "A", "it's"), ("D", "S", "T", "MISSING", "x"), ("E", "S", "T", "A", "y"),
    )
    columns = catalog.drop("comments").where("column_name = 'A'")
    found = rows(g.comment_plan(catalog, columns.union(columns), db="D").select("status", "statement"),
                 "status")
    assert found == [
        ("apply", "ALTER TABLE D.S.T ALTER COLUMN A comment 'it''s'"), ("failed", None)
    ]
    assert g.comment_plan(catalog, columns, table="OTHER").count() == 3
    assert g.comment_plan(catalog, columns, "D", "S", "OTHER").count() == 0


def test_masking_keeps_rows_and_other_columns(frame):
    df = frame("`e.mail` string, n int", ("a", 1), (None, 2))
    tags = frame("column_name string, tag_name string, tag_value string",
                 ("e.mail", "security_class", "PII"), ("n", "security_class", "PUBLIC"))
    assert rows(g.mask_by_tag(df, tags), "n") == [("**Masked**", 1), ("**Masked**", 2)]


def test_masking_ignores_case_and_can_ask_for_the_table(frame):
    df = frame("email string, n int", ("a", 1))
    tags = frame("object_name string, column_name string, tag_name string, tag_value string",
                 ("T", "EMAIL", "SECURITY_CLASS", "PII"), ("OTHER", "N", "security_class", "PII"))
    assert rows(g.mask_by_tag(df, tags, table="t")) == [("**Masked**", 1)]
    assert rows(g.mask_by_tag(df, tags)) == [("**Masked**", "**Masked**")]


def test_the_latest_of_several_attempts_counts(frame, at):
    key = "table_catalog string, table_schema string, table_name string"
    inventory = frame(
        f"{key}, storage_bytes bigint, row_count bigint, owner string, "
        "current_time_travel_duration int, change_tt string, last_updated timestamp_ntz, comments string",
        ("D", "S", "T", 1, 1, "o", 9, "Y", None, ""),
    )
    tries = frame(f"{key}, succeeded boolean, attempted_at int",
                  ("D", "S", "T", False, 1), ("D", "S", "T", True, 2))
    now = at("1998-07-01 06:00:00")
    (row,) = g.apply_retention_outcome(inventory, tries, now).collect()
    assert row.change_tt == "N"
    (row,) = g.apply_retention_outcome(inventory, tries.drop("attempted_at"), now).collect()
    assert row.change_tt == "N"


def test_cost_is_split_over_distinct_tables(frame, at):
    log = frame(
        "query_id bigint, base_objects_accessed string",
        (1, '[{"objectName":"D.S.T"},{"objectName":"D.S.U"},{"objectName":"D.S.T"}]'),
        (1, '[{"objectName":"D.S.U"}]'), (2, '[{"objectName":"D.S.T"}]'),
    )
    history = frame("query_id bigint, warehouse_name string, user_name string",
                    (1, "W", "u"), (2, "W", "u"))
    attribution = frame("query_id bigint, credits_attributed_compute decimal(18,4)",
                        (1, 3), (1, 1), (2, 5))
    tags = frame("domain string, object_database string, object_schema string, "
                 "object_name string, tag_name string, tag_value string",
                 ("TABLE", "D", "S", "T", "DEPARTMENT", "finance"),
                 ("TABLE", "D", "S", "U", "DEPARTMENT", "ops"),
                 ("TABLE", "D9", "S", "T", "DEPARTMENT", "other"))
    found = g.cost_by_tag(log, history, attribution, tags)
    assert {r.tag_value: (float(r.credits), r.object_uses) for r in found.collect()} == {
        "finance": (7.0, 2), "ops": (2.0, 1)
    }


def test_tags_come_from_the_nearest_container_and_costs_add_up(frame, at):
    access = frame(
        "query_id bigint, user_name string, query_start_time timestamp_ntz, base_objects_accessed string",
        *((q, "U", at("1998-06-30 00:00:00"), f'[{{"objectName":"{name}"}}]') for q, name in
          enumerate(["D1.S1.T1", "D1.S1.T2", "D1.S2.T1", "D2.S1.T1", "D3.S9.T9"])),
    )
    history = frame(
        "query_id bigint, start_time timestamp_ntz, warehouse_name string, user_name string",
        *((q, at("1998-06-30 00:00:00"), "W1" if q < 3 else "W2", "U") for q in range(5)),
    )
    attribution = frame(
        "query_id bigint, start_time timestamp_ntz, credits_attributed_compute decimal(18,4)",
        *((q, at("1998-06-30 00:00:00"), 2**q) for q in range(5)),
    )
    schema = "domain string, object_database string, object_schema string, object_name string, tag_name string, tag_value string"
    tags = [
        ("TABLE", "D1", "S1", "T1", "DEPARTMENT", "table"), ("SCHEMA", "D1", None, "S1", "DEPARTMENT", "schema"),
        ("DATABASE", None, None, "D1", "DEPARTMENT", "database"), ("DATABASE", None, None, "D2", "OTHER", "x"),
        ("WAREHOUSE", None, None, "W1", "DEPARTMENT", "house"),
    ]
    arguments = (access, history, attribution)
    found = g.cost_by_inherited_tag(*arguments, frame(schema, *tags))
    assert sorted(((r.tag_value, r.tag_level, r.warehouse_tag, float(r.credits), r.object_uses)
                   for r in found.collect()), key=repr) == sorted([
        ("table", "table", "house", 1, 1), ("schema", "schema", "house", 2, 1),
        ("database", "database", "house", 4, 1), (None, None, None, 24, 2)], key=repr)
    account = ("ACCOUNT", None, None, "ACC", "DEPARTMENT", "account")
    found = g.cost_by_inherited_tag(*arguments, frame(schema, *tags, account))
    assert {(r.tag_value, float(r.credits)) for r in found.collect()} >= {("account", 24.0)}
    assert "NestedLoop" not in plan(found)

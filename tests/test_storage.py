import datetime as dt
from decimal import Decimal

from conftest import rows

from meterlens.plans import storage as s

TB = 2**40
STORAGE = (
    "account_name string, database_name string, usage_date timestamp_ntz, "
    "average_database_bytes bigint, average_failsafe_bytes bigint, "
    "average_hybrid_table_storage_bytes bigint"
)


def test_sizes_are_monthly_maxima_and_turn_wide(frame, at):
    df = frame(
        STORAGE, ("A", "D", at("1998-01-05 00:00:00"), 2 * TB, TB, 0),
        ("A", "D", at("1998-01-06 00:00:00"), 3 * TB, 0, 0),
        ("A", "D", at("1998-02-06 00:00:00"), TB // 20 + 1, 0, 0),
        ("A", "D", at("1997-01-06 00:00:00"), 9 * TB, 0, 0),
    )
    sizes = s.database_sizes(df, 1998, [1, 2, 3])
    assert rows(sizes) == [("D", 1, 3.0, 1.0), ("D", 2, 0.1, 0.0)]
    assert rows(s.database_sizes_wide(sizes, {1: "jan", 2: "feb", 3: "mar"})) == [
        ("D", "Average Active Size in TB", 3.0, 0.1, None),
        ("D", "Average Failsafe Size in TB", 1.0, 0.0, None),
    ]


def test_live_tables_with_last_months_clustering(frame, at):
    schema = (
        "id bigint, table_catalog string, table_schema string, table_name string, deleted {}, "
        "active_bytes bigint, failsafe_bytes bigint, time_travel_bytes bigint"
    )
    clustering = frame(
        "table_id bigint, database_name string, schema_name string, table_name string, "
        "start_time timestamp_ntz, credits_used decimal(18,2)",
        (1, "C", "S", "T", at("1998-06-30 00:00:00"), 2), (1, "C", "S", "T", at("1998-07-01 00:00:00"), 9),
    )
    for kind, live, gone in (("boolean", False, True), ("string", "FALSE", "TRUE")):
        metrics = frame(
            schema.format(kind), (1, "C", "S", "T", live, TB, 0, 0), (2, "C", "S", "U", live, 0, 0, 0),
            (3, "C", "S", "V", gone, TB, 0, 0),
        )
        found = s.table_storage_cost(metrics, clustering, "1998-07-15").collect()
        assert [(r.table_name, float(r.total_active_cost_per_month),
                 float(r.total_auto_clustering_cost)) for r in found] == [
            ("T", 16.86, 4.64), ("U", 0.0, 0.0)
        ]


def test_organisation_cost_sums_rounded_accounts(frame, at):
    day = at("1998-06-05 00:00:00")
    df = frame(
        STORAGE, ("A", "D", day, TB, 0, TB // 2), ("A", "E", day, TB, 2 * TB, 0),
        ("B", "D", day, TB // 25, 0, 0), ("X", "D", day, 5 * TB, 0, 0),
    )
    (row,) = rows(s.org_storage_cost(df, "1998-06-01", "1998-07-01", exclude=["X"]))
    assert row == (dt.date(1998, 6, 1), Decimal("2.5"), Decimal("2.0"), Decimal("46.00"),
                   Decimal("36.80"))

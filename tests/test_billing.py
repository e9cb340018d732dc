import datetime as dt
from decimal import Decimal

from conftest import plan, rows
from pyspark.sql import functions as F

from meterlens.operators.months import drop_all_zero, pivot_months
from meterlens.plans import billing as b

METERING = (
    "account_name string, warehouse_name string, start_time timestamp_ntz, "
    "credits_used_compute decimal(18,2)"
)
HISTORY = (
    "service_type string, name string, entity_id bigint, start_time timestamp_ntz, "
    "credits_used_compute decimal(18,2), credits_used_cloud_services decimal(18,2)"
)
TABLES = "table_id bigint, table_catalog string"
D = Decimal


def test_compute_covers_full_months_and_drops_free_usage(frame, at):
    df = frame(
        METERING, ("A", "W", at("1998-05-31 23:59:59"), 1), ("A", "W", at("1998-06-01 00:00:00"), 2),
        ("A", "W", at("1998-06-30 23:59:59"), None), ("A", "W", at("1998-07-01 00:00:00"), 4),
        ("A", "FREE", at("1998-06-10 00:00:00"), 0),
    )
    assert rows(b.bill_compute(df, "1998-07-15")) == [
        ("A", "W", "COMPUTE", dt.date(1998, 6, 1), D(2), D("4.8"))
    ]
    assert b.bill_compute(df, "1998-07-15", months=2).count() == 2


def test_services_use_cloud_credits_for_warehouses(frame, at):
    when = at("1998-06-10 00:00:00")
    df = frame(
        HISTORY, ("WAREHOUSE_METERING", "W", 1, when, 9, 1), ("WAREHOUSE_METERING", "W", 1, when, 9, None),
        ("PIPE", "P", 2, when, 3, 8), ("AUTO_CLUSTERING", "C", 3, when, 5, 5),
    )
    found = rows(b.bill_services(df, "1998-07-01", account="X"), "service_type")
    assert [(r[1], r[2], r[4], r[5]) for r in found] == [
        ("W", "CLOUD SERVICES", D(1), D("2.4")), ("P", "PIPE", D(3), D("7.2"))
    ]


def test_search_optimisation_joins_the_id_in_the_name(frame, at):
    when = at("1998-06-10 00:00:00")
    name = "SEARCH OPTIMIZATION ON TABLE ID 0000000042"
    df = frame(
        HISTORY, ("SEARCH_OPTIMIZATION", name, 0, when, 2, None),
        ("SEARCH_OPTIMIZATION", "short", 0, when, 5, None),
        ("SEARCH_OPTIMIZATION", name, 0, when, None, None),
    )
    tables = frame(TABLES, (42, "DB"), (42, "DB"), (43, "OTHER"))
    (row,) = rows(b.bill_search_opt(df, tables, "1998-07-01", account="X"))
    assert row[1:2] + row[4:] == ("DB", D(2), D("4.8"))


def test_full_bill_keeps_three_storage_decimals(frame, at):
    when = at("1998-06-10 00:00:00")
    storage = frame(
        "account_name string, database_name string, usage_date timestamp_ntz, "
        "average_database_bytes bigint, average_failsafe_bytes bigint",
        ("A", "DB", when, 5_236_000_000_000, 0),
    )
    none = frame(HISTORY)
    mv = frame("database_name string, service_type string, start_time timestamp_ntz, "
               "credits_used decimal(18,2)")
    bill = b.full_bill(
        frame(METERING, ("A", "W", when, 2)), none, frame(TABLES), mv, storage, "1998-07-01",
        account="A",
    )
    assert [(r.service_type, r.total_credits) for r in bill.collect()] == [
        ("STORAGE", D("4.762")), ("COMPUTE", D(2))
    ]


def test_price_changes_with_the_calendar_month(frame, at):
    df = frame(
        METERING + ", service_type string",
        ("A", "W", at("2025-04-30 23:59:59"), 1, "S"), ("A", "W", at("2025-05-01 00:00:00"), 1, "S"),
        ("A", None, at("2025-05-01 00:00:00"), 1, "S"),
        ("A", "CLOUD_SERVICES_ONLY", at("2025-05-01 00:00:00"), 1, "S"),
    )
    cost = b.tiered_cost(b.clean_credits(df))
    assert [r.billable_usage for r in cost.orderBy("usage_month").collect()] == [D("2.32"), D("2.56")]


def test_pivot_sums_to_the_unpivoted_total_and_excludes_accounts(frame):
    df = frame(
        "account_name string, month string, v bigint", ("A", "2024-Jan", 1), ("A", "2024-Jan", 2),
        ("A", "2024-Feb", 4), ("B", "2024-Feb", 8), ("C", "2024-Jan", 16),
    )
    wide = pivot_months(df, ["account_name"], ["2024-Jan", "2024-Feb", "2024-Mar"], "v", ["C"])
    assert rows(wide, "account_name") == [("A", 3, 4, None), ("B", None, 8, None)]


def test_owner_is_other_when_unknown_and_empty_rows_go(frame):
    wide = frame(
        "account_name string, warehouse_name string, jan_24 bigint", ("A", "W", 1), ("A", "X", None),
        ("B", "W", 2),
    )
    xref = frame(
        "account_name string, wh_name string, application string, owner string",
        ("A", "W", None, "me"),
    )
    filled = b.fill_months(wide, ["jan_24"], {"A": "A1"})
    assert {r.act_name for r in filled.collect()} == {"A1", "B"}
    owned = b.wide_with_owner(filled, xref, ["jan_24"])
    assert rows(drop_all_zero(owned, ["jan_24"])) == [
        ("A", "W", "Other", "me", 1), ("B", "W", "Other", "Other", 2)
    ]


def test_whole_chain_equals_its_steps(frame, at):
    df = frame(
        METERING + ", service_type string", ("A", "W", at("2025-04-30 23:59:59"), 1, "S"),
        ("A", "X", at("2024-01-01 00:00:00"), 1, "S"),
    )
    xref = frame("account_name string, wh_name string, application string, owner string")
    assert rows(b.owner_month_report(df, xref, ["2025-Apr", "2025-May"])) == [
        ("A", "W", "Other", "Other", D("2.32"), D(0))
    ]


def test_year_to_date_ends_with_the_previous_month(frame):
    usage = frame(
        "account_name string, service_type string, usage_date date, usage_in_currency decimal(18,2)",
        *(("A", "S", dt.date.fromisoformat(d), 1) for d in
          ("1997-06-30", "1997-07-01", "1998-01-01", "1998-06-30", "1998-07-01")),
    )
    assert b.account_monthly(usage, "1998-07-01").count() == 2
    monthly = b.service_monthly(usage, "1998-07-01")
    assert monthly.count() == 3
    totals = b.service_month_totals(monthly)
    assert rows(b.service_pivot(totals, ["1997-Jul", "1997-Aug"])) == [("S", D(1), D(0))]
    assert rows(b.data_bounds(usage, "usage_date")) == [
        (dt.date(1997, 6, 30), dt.date(1998, 7, 1), 5)
    ]
    assert b.rates_on(usage, "S", "1998-06-30", "usage_date").count() == 1


def test_rates_with_a_gap_and_an_overlap_are_reported(frame, at):
    rates = frame(
        "account_name string, valid_from date, valid_to date, price decimal(6,2)",
        ("A", dt.date(2024, 1, 1), dt.date(2024, 3, 1), 2), ("A", dt.date(2024, 2, 1), dt.date(2024, 4, 1), 3),
        ("A", dt.date(2024, 6, 1), None, 4), ("B", dt.date(2024, 1, 2), None, 5),
    )
    credits = frame(
        "account_name string, service_type string, warehouse_name string, start_time timestamp_ntz, "
        "credits_used_compute decimal(18,2)",
        *(("A", "S", "W", at(f"2024-{month:02}-15 00:00:00"), 10) for month in (1, 2, 3, 5, 6, 12)),
        ("B", "S", "W", at("2024-01-31 00:00:00"), 1), ("B", "S", "W", at("2024-02-01 00:00:00"), 1),
        (None, "S", "W", at("2024-02-01 00:00:00"), 1),
    )
    found = b.rated_cost(credits, rates).orderBy(F.asc_nulls_last("account_name"), "usage_month").collect()
    assert [(r.account_name, r.usage_month.month, r.status, r.rates, r.billable_usage and float(r.billable_usage))
            for r in found] == [
        ("A", 1, "priced", 1, 20), ("A", 2, "overlap", 2, None), ("A", 3, "priced", 1, 30),
        ("A", 5, "gap", 0, None), ("A", 6, "priced", 1, 40), ("A", 12, "priced", 1, 40),
        ("B", 1, "gap", 0, None), ("B", 2, "priced", 1, 5), (None, 2, "gap", 0, None),
    ]


def test_the_full_bill_reads_the_metering_log_once(spark):
    import registry

    text = plan(registry.all_queries()["b07_full_bill"](spark, "/root/testdata/sf0.001"))
    # No other log of the bill takes this column of the base table.
    assert sum("l_tax" in line for line in text.splitlines() if "FileScan" in line) == 1

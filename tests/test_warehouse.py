import datetime as dt
import random

import pytest
from conftest import plan, rows

from meterlens.plans import warehouse as w

METERING = (
    "warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "credits_used decimal(18,2), credits_used_compute decimal(18,2)"
)
LOAD = (
    "warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "avg_running decimal(18,6), avg_queued_load decimal(18,6), "
    "avg_queued_provisioning decimal(18,6), avg_blocked decimal(18,6), execution_time decimal(18,2)"
)


def test_trend_has_no_change_without_a_base(frame, at):
    df = frame(
        METERING, ("A", at("1998-06-01 00:00:00"), None, 10, None),
        ("A", at("1998-07-01 08:00:00"), None, 15, None),
        ("B", at("1998-07-01 00:00:00"), None, 5, None),
        ("C", at("1998-06-30 00:00:00"), None, 5, None),
        ("A", at("1998-02-28 00:00:00"), None, 99, None),
        ("B", at("1998-06-15 00:00:00"), None, -3, None),
    )
    trend = w.credit_trend(df, frame("name string", ("A",), ("B",)), "1998-07-01")
    found = [(r.warehouse_name, float(r.last_month_costs), float(r.current_month_costs),
              r.percent_change) for r in trend.collect()]
    assert found == [("A", 25.6, 38.4, 50.0), ("B", 0.0, 12.8, None)]


def test_weeks_start_on_monday(frame, at):
    df = frame(
        METERING, ("A", at("1998-06-28 23:59:59"), None, 4, None),
        ("A", at("1998-06-29 00:00:00"), None, 100, None),
        ("A", at("1998-06-21 23:59:59"), None, 2, None),
    )
    (row,) = w.credit_trend(df, frame("name string", ("A",)), "1998-07-01", "week").collect()
    assert (float(row.last_week), float(row.week_2), row.percent_change) == (4.0, 2.0, 100.0)


def test_idle_minutes_go_below_zero(frame, at):
    df = frame(
        LOAD, ("WH_1", at("2024-01-30 00:00:00"), at("2024-01-30 00:05:00"), 1.5, 0.25, 0, 0.25, 0),
        ("OTHER", at("2024-01-30 00:00:00"), at("2024-01-30 00:05:00"), 1, 0, 0, 0, 0),
        ("WH_1", at("2024-01-23 23:59:59"), at("2024-01-24 00:05:00"), 1, 0, 0, 0, 0),
    )
    assert rows(w.load_minutes(df, "2024-01-30", "%WH%")) == [("WH_1", 5.0, 10.0, -5.0)]


def test_utilisation_without_credits_is_null(frame, at):
    start, end = at("2024-01-30 01:00:00"), at("2024-01-30 02:00:00")
    metering = frame(METERING, ("A", start, end, 1, 2), ("A", start, end, 1, 2), ("B", start, end, 0, 0))
    load = frame(LOAD, ("A", start, end, 0, 0, 0, 0, 1800))
    day = dt.date(2024, 1, 30)
    assert rows(w.daily_utilisation(metering, load, "2024-01-30")) == [
        ("A", day, 12.5, 87.5), ("B", day, None, None)
    ]
    warehouses = frame("name string, size string", ("A", "XSMALL"), ("B", "ODD"))
    each = w.sized_utilisation(metering, load, warehouses, "2024-01-30")
    assert rows(each) == [("A", day, 6.25, 93.75)] * 2
    daily = w.sized_utilisation(metering, load, warehouses, "2024-01-30", daily=True)
    assert [r[2] for r in rows(daily)] == [3.13]


QUERIES = "warehouse_name string, start_time timestamp_ntz"


def test_gaps_are_whole_seconds_and_pass_midnight(frame, at):
    metering = frame(
        METERING,
        ("A", at("2024-01-15 01:00:00"), at("2024-01-15 02:00:00"), 0, 0),
        ("A", at("2024-01-15 01:00:00"), at("2024-01-15 02:00:00.900000"), 0, 0),
        ("A", at("2024-01-15 03:00:00"), at("2024-01-15 02:00:00"), 0, 0),
        ("A", at("2024-01-15 23:00:00"), at("2024-01-16 00:00:00"), 0, 0),
        ("A", at("2024-01-15 22:00:00"), at("2024-01-15 23:00:00"), 0, 0),
        ("B", at("2024-01-15 01:00:00"), at("2024-01-15 02:00:00"), 0, 0),
    )
    queries = frame(
        QUERIES, ("A", at("2024-01-15 02:00:00.500000")), ("A", at("2024-01-15 02:00:01.300000")),
        ("A", at("2024-01-15 02:30:00")), ("A", at("2024-01-16 00:10:00")),
    )
    found = rows(w.idle_gaps(metering, queries), "warehouse_end_time")
    same_day, next_day = (at("2024-01-15 02:00:01.300000"), 1, 2), at("2024-01-16 00:10:00")
    assert [r[3:] for r in found] == [same_day, same_day, (next_day, 4200, 1), (next_day, 600, 1)]
    assert w.idle_gaps(metering, queries, "2024-01-15").count() == 2
    assert w.idle_gaps(metering, queries, "2024-01-16").count() == 0
    assert w.idle_gaps(metering, queries, "2024-01-15", "B").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_gaps_equal_the_nearest_later_query(frame, at, seed):
    random.seed(seed)
    midnight = at("2024-01-15 00:00:00")

    def moment(seconds):
        return midnight + dt.timedelta(seconds=seconds)

    intervals = [(random.choice("AB"), moment(s), moment(s + random.randint(0, 900)), 0, 0)
                 for s in random.sample(range(0, 80000), 40)]
    queries = [(random.choice("AB"), moment(random.randint(0, 86000) + random.random()))
               for _ in range(60)]
    expected = set()
    for name, start, end, *_ in intervals:
        later = [q for n, q in queries if n == name and q.date() == start.date()
                 and q.replace(microsecond=0) > end]
        if later:
            first = min(later)
            gap = (first.replace(microsecond=0) - end) // dt.timedelta(seconds=1)
            expected.add((name, start, end, first, gap, len(later)))
    df = w.idle_gaps(frame(METERING, *intervals), frame(QUERIES, *queries))
    assert set(rows(df)) == expected
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_queries_inside_count_both_bounds(frame, at):
    metering = frame(
        "warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz",
        ("A", at("2024-01-01 00:30:00"), at("2024-01-01 03:30:00")),
        ("A", at("2024-01-01 00:30:00"), at("2024-01-01 03:30:00")),
        ("A", at("2024-01-01 01:00:00"), at("2024-01-01 01:00:00")),
        ("A", at("2024-01-01 23:59:59.5"), at("2024-01-02 00:00:00.25")),
        ("B", at("2024-01-01 00:30:00"), at("2024-01-01 03:30:00")),
        ("C", at("2024-01-01 04:00:00"), at("2024-01-01 03:00:00")),
    )
    times = ["2024-01-01 00:29:59.999", "2024-01-01 00:30:00", "2024-01-01 01:00:00", "2024-01-01 01:00:00",
             "2024-01-01 02:59:59", "2024-01-01 03:30:00", "2024-01-01 03:30:00.001",
             "2024-01-01 23:59:59.4", "2024-01-02 00:00:00.25"]
    queries = frame(
        "warehouse_name string, start_time timestamp_ntz",
        *(("A", at(t)) for t in times), ("C", at("2024-01-01 03:30:00")),
    )
    expected = [
        ("A", at(times[1]), at(times[5]), 5, at(times[1]), at(times[5])),
        ("A", at(times[2]), at(times[2]), 2, at(times[2]), at(times[2])),
        ("A", at("2024-01-01 23:59:59.5"), at(times[8]), 1, at(times[8]), at(times[8])),
        ("B", at(times[1]), at(times[5]), 0, None, None),
    ]
    for seconds in (60, 3600, 86400 * 7):
        found = w.queries_inside(metering, queries, bin_seconds=seconds)
        assert rows(found, "warehouse_name", "warehouse_start_time") == expected
    one = w.queries_inside(metering, queries, "2024-01-01", "A")
    assert [r.queries for r in one.orderBy("warehouse_start_time").collect()] == [5, 2, 0]
    assert "NestedLoop" not in plan(one) and "Cartesian" not in plan(one)

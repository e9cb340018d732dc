import pytest
from conftest import plan, rows

from meterlens.operators.latest import latest_per_key
from meterlens.plans import query_log as q

HISTORY = (
    "query_id bigint, start_time timestamp_ntz, total_elapsed_time bigint, warehouse_name string, "
    "query_type string, query_parameterized_hash bigint, query_text string, user_name string, "
    "role_name string, execution_status string, error_code int, error_message string, "
    "rows_produced bigint, bytes_scanned bigint, bytes_spilled_to_local_storage bigint, "
    "bytes_spilled_to_remote_storage bigint, bytes_sent_over_the_network bigint, "
    "partitions_scanned bigint, partitions_total bigint"
)
ATTRIBUTION = "query_id bigint, start_time timestamp_ntz, credits_attributed_compute decimal(18,4)"


@pytest.fixture
def history(frame, at):
    def build(*changes):
        base = {
            "query_id": 1, "start_time": at("1998-06-30 12:00:00"), "total_elapsed_time": 60000,
            "warehouse_name": "WH", "query_type": "SELECT", "query_parameterized_hash": 7,
            "query_text": "select", "user_name": "U", "role_name": "R",
            "execution_status": "SUCCESS", "error_code": None, "error_message": None,
            "rows_produced": 1, "bytes_scanned": 10, "bytes_spilled_to_local_storage": 0,
            "bytes_spilled_to_remote_storage": 0, "bytes_sent_over_the_network": 0,
            "partitions_scanned": 5, "partitions_total": 10,
        }
        return frame(HISTORY, *(tuple({**base, **change}.values()) for change in changes))

    return build


def test_bucket_edges_belong_to_the_lower_bucket(history):
    times = (0, 1, 60000, 60001, 300000, 600000, 1800000, 1800001)
    df = history(*({"query_id": i, "total_elapsed_time": t} for i, t in enumerate(times)))
    assert dict(rows(q.duration_buckets(df))) == {
        "<60s": 2, "60s-5m": 2, "5m-10m": 1, "10m-30m": 1, ">30m": 1
    }


def test_lines_sum_to_the_filtered_count(history, at):
    df = history(
        {"query_id": 1}, {"query_id": 2, "query_type": "INSERT"},
        {"query_id": 3, "start_time": at("1998-05-01 00:00:00")},
        {"query_id": 4, "start_time": at("1997-05-01 00:00:00")},
        {"query_id": 5, "warehouse_name": "OTHER"},
    )
    lines = rows(q.monthly_query_lines(df, 1998, [5, 6], "WH"))
    assert lines == [("5|1",), ("6|2",)]
    assert rows(q.monthly_type_lines(df, 1998, [6])) == [("6|SELECT|2",), ("6|INSERT|1",)]
    assert rows(q.duration_bucket_lines(df, 1998, [5, 6], "WH")) == [("5|<60s|1",), ("6|<60s|2",)]


def test_costliest_shapes_weighs_repeated_attribution(frame, history, at):
    df = history(
        {"query_id": 1, "bytes_spilled_to_local_storage": 10},
        {"query_id": 2, "total_elapsed_time": 120000, "query_text": "latest",
         "start_time": at("1998-07-01 23:59:59"), "bytes_spilled_to_local_storage": 40},
        {"query_id": 3, "query_parameterized_hash": None},
        {"query_id": 4, "query_parameterized_hash": 8},
        {"query_id": 5, "start_time": at("1998-07-02 00:00:00")},
    )
    attribution = frame(
        ATTRIBUTION,
        *((query, at("1998-06-30 00:00:00"), credit) for query, credit in
          ((1, 1), (1, 2), (2, 4), (3, 9))),
    )
    (row,) = q.costliest_shapes(df, attribution, "1998-07-01").collect()
    assert row.no_of_runs == 3
    assert float(row.total_execution_time_mins) == 4.0
    assert float(row.avg_execution_time_mins) == 1.33
    assert float(row.total_query_cost) == 17.92
    assert row.bytes_spilled_local == 20.0
    assert row.query_text == "latest"


def test_costly_runs_threshold_is_inclusive(frame, history):
    df = history({"query_id": 1}, {"query_id": 2}, {"query_id": 3, "partitions_scanned": None})
    attribution = frame(
        "query_id bigint, credits_attributed_compute decimal(18,4)", (1, 195.3125), (2, 195.3124),
        (3, 900),
    )
    assert [r.query_id for r in q.costly_runs(df, attribution, 6).collect()] == [1]


def test_failure_groups_take_the_earliest_example(history, at):
    failed = {"execution_status": "FAIL", "error_code": 1, "error_message": "e"}
    df = history(
        {**failed, "query_id": 1, "start_time": at("1998-06-30 10:00:00"), "query_text": "b"},
        {**failed, "query_id": 2, "start_time": at("1998-06-24 00:00:00"), "query_text": "a"},
        {**failed, "query_id": 3, "start_time": at("1998-06-23 23:59:59"), "query_text": "old"},
        {"query_id": 4},
    )
    (row,) = q.failure_groups(df, "1998-07-01").collect()
    assert (row.failure_count, row.example_query_text) == (2, "a")


def test_latest_per_key_equals_row_number(frame):
    df = frame("k int, t int, v string", (1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (None, 1, "d"))
    assert rows(latest_per_key(df, ["k"], ["t"]), "v") == [(1, 3, "b"), (None, 1, "d")]


def test_date_filter_reaches_the_scan(spark):
    from meterlens.sources.usage_logs import usage_log

    history = usage_log(spark, "/root/testdata/sf0.001", "query_history")
    text = plan(q.failure_groups(history, "1998-07-01"))
    assert "GreaterThanOrEqual(o_orderdate" in text.replace("PushedFilters", "")
    assert "CartesianProduct" not in text and "Python" not in text


def nodes_before_any_exchange(text):
    """Plan nodes without an exchange below them: they work on all rows of the log."""
    lines = text.splitlines()
    depths = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    for at, (line, depth) in enumerate(zip(lines, depths)):
        below = at + 1
        while below < len(lines) and depths[below] > depth:
            below += 1
        if not any("Exchange" in inner for inner in lines[at:below]):
            yield line


def test_latest_rows_are_fetched_without_sorting_text(spark, frame):
    import registry

    for name in ("q05_costliest_shapes", "q07_failure_groups", "q08_latest_per_key"):
        text = plan(registry.all_queries()[name](spark, "/root/testdata/sf0.001"))
        early = [line for line in nodes_before_any_exchange(text) if "Sort" in line]
        assert early and not any("query_text" in line for line in early)
    df = frame("k int, t int, v string", (1, 3, "b"), (1, None, "c"), (None, None, "d"), (None, None, "d"))
    assert rows(latest_per_key(df, ["k"], ["t"]), "v") == [(1, 3, "b"), (None, None, "d")]


def test_failure_examples_of_groups_with_null_keys(history, at):
    failed = {"execution_status": "FAIL", "error_code": None, "error_message": None}
    df = history(
        {**failed, "query_id": 1, "query_text": "x"}, {**failed, "query_id": 1, "query_text": "x"},
        {**failed, "query_id": 2, "query_type": None, "query_text": "y"},
    )
    found = q.failure_groups(df, "1998-07-01").select("failure_count", "example_query_text")
    assert rows(found, "failure_count") == [(1, "y"), (2, "x")]
    assert rows(q.failure_groups(df, "1998-07-01", limit=1).select("failure_count")) == [(2,)]


def test_costly_runs_of_a_month_in_every_year(frame, history, at):
    df = history(
        {"query_id": 1, "start_time": at("1996-05-31 23:59:59")}, {"query_id": 2, "start_time": at("1997-06-01 00:00:00")},
        {"query_id": 3, "start_time": at("1998-05-01 00:00:00")}, {"query_id": 4, "start_time": at("1999-01-01 00:00:00")},
    )
    attribution = frame(ATTRIBUTION, *((i, at("1998-05-01 00:00:00"), 900) for i in (1, 2, 3, 4)))
    attribution = attribution.drop("start_time").join(df.select("query_id", "start_time"), "query_id")
    assert sorted(r.query_id for r in q.costly_runs(df, attribution, 5).collect()) == [1, 3]
    assert [r.query_id for r in q.costly_runs(df, attribution, 5, year=1998).collect()] == [3]
    assert rows(q.costly_runs(df.limit(0), attribution, 5)) == []


def test_costly_runs_push_a_range_to_both_logs(spark):
    import registry

    text = plan(registry.all_queries()["q06_costly_runs"](spark, "/root/testdata/sf0.001"))
    scans = [line for line in text.splitlines() if "FileScan" in line and "o_orderdate" in line]
    assert len(scans) == 2
    assert "o_orderdate" in scans[0] and ">= 1995-05-01 00:00:00) AND" in scans[0]
    assert ">= 1995-04-30 00:00:00) AND" in scans[1]  # a day more of the attribution

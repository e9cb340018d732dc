import json
import random
import re

import pytest
from conftest import plan, rows

from meterlens.operators.ordering import with_previous, with_row_number
from meterlens.plans import operator_metrics as m

HISTORY = "query_id bigint, start_time timestamp_ntz, total_elapsed_time bigint"
OPERATORS = (
    "query_id bigint, step_id int, operator_id int, operator_type string, "
    "operator_statistics string"
)


def statistics(inputs=10, outputs=5, local=0, remote=0, scanned=0, total=0):
    return json.dumps(
        {
            "input_rows": inputs, "output_rows": outputs,
            "spilling": {"bytes_spilled_local_storage": local,
                         "bytes_spilled_remote_storage": remote},
            "pruning": {"partitions_scanned": scanned, "partitions_total": total},
        }
    )


@pytest.fixture
def history(frame, at):
    ages = {1: "1998-07-01 23:00:00", 2: "1998-06-25 00:00:00", 3: "1998-06-24 12:00:00",
            4: "1998-06-23 23:59:59", 5: "1998-06-17 00:00:00", 6: "1998-06-16 23:59:59",
            7: "1998-07-02 00:00:00"}
    return frame(HISTORY, *((q, at(t), 100 * q) for q, t in ages.items()))


def test_windows_leave_out_age_seven_and_the_future(history, frame):
    operators = frame(OPERATORS, *((q, 1, 1, "Join", statistics(1, 2)) for q in range(1, 8)))
    counts = m.exploding_counts(history, operators, "1998-07-01").select("counts.*").first()
    assert counts.asDict() == {"7_days": 2, "8_14_days": 2}
    assert rows(m.exploding_queries(history, operators, "1998-07-01"), "query_id") == [(1,), (2,)]
    assert rows(m.slowest_queries(history, "1998-07-01", 8, 14, 1)) == [(5, 500)]


def test_flag_edges(history, frame):
    cases = [
        ("equal", statistics(5, 5)), ("no input", statistics(0, 5)), ("grows", statistics(5, 6)),
        ("local", statistics(local=1)), ("remote", statistics(remote=1)),
        ("share", statistics(scanned=16000, total=20000)),
        ("few", statistics(scanned=19999, total=19999)),
        ("low", statistics(scanned=15999, total=20000)), ("zero", statistics(scanned=1, total=0)),
        ("empty", "{}"), ("broken", "not json"),
    ]
    operators = frame(OPERATORS, *((1, 1, i, name, s) for i, (name, s) in enumerate(cases)))
    flags = {
        row.operator_type: [f for f in m.FLAGS if f in row and row[f]]
        for row in m.with_statistic_flags(operators).collect()
    }
    assert {name: found for name, found in flags.items() if found} == {
        "grows": ["exploding_join"], "local": ["queries_too_large_memory"],
        "remote": ["queries_too_large_memory"], "share": ["inefficient_pruning"],
    }


def test_union_flag_looks_across_steps_but_not_across_queries(history, frame):
    operators = frame(
        OPERATORS, (1, 1, 1, "Aggregate", "{}"), (1, 2, 2, "UnionAll", "{}"),
        (2, 1, 1, "UnionAll", "{}"), (2, 1, 2, "Aggregate", "{}"), (2, 1, 3, "Join", "{}"),
        (2, 1, 4, "UnionAll", "{}"),
    )
    flagged = m.union_distinct_queries(history, operators, "1998-07-01")
    assert rows(flagged) == [(1,)]


def test_blocks_give_the_same_previous_value_as_one_window(frame):
    random.seed(3)
    data = [(k, i, random.choice("abc")) for k in range(3)
            for i in random.sample(range(60), 20)]
    df = frame("k int, i int, v string", *data)
    expected = set()
    for key in range(3):
        before = None
        for _, i, v in sorted(r for r in data if r[0] == key):
            expected.add((key, i, v, before))
            before = v
    for block in (1, 4, 7, 1000):
        assert set(rows(with_previous(df, "k", ["i"], "v", "p", block))) == expected


def test_previous_value_reads_its_input_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 k", "id i", "cast(id as string) v").write.parquet(
        str(tmp_path / "t")
    )
    df = with_previous(spark.read.parquet(str(tmp_path / "t")), "k", ["i"], "v", "p")
    df.collect()
    final = plan(df)
    assert "ReusedExchange" in final.split("Initial Plan")[0]


def test_row_numbers_follow_slot_then_order(frame):
    data = sorted((o % 4, o % 3, o) for o in range(40))
    df = frame("s int, t int, o int", *data)
    expected = [(*row, n + 1) for n, row in enumerate(data)]
    for slots, order in ((["s"], ["t", "o"]), (["s", "t"], ["o"]), (["s", "t", "o"], ["o"])):
        assert rows(with_row_number(df, slots, order, "n"), "n") == expected


def test_summary_drops_queries_without_statistics(history, frame):
    operators = frame(
        OPERATORS, (1, 1, 1, "Aggregate", statistics(1, 2, local=1)),
        (1, 1, 2, "UnionAll", statistics(1, 2)), (4, 1, 1, "Join", statistics()),
    )
    summary = m.operator_metric_summary(history, operators, "1998-07-01")
    found = {(r.query_id, r.window): [r[f] for f in m.FLAGS] for r in summary.collect()}
    assert found == {(1, "7_days"): [2, 1, 1, 0], (4, "8_14_days"): [0, 0, 0, 0]}


def test_daily_load_is_idempotent_and_expires(history, frame, tmp_path):
    operators = frame(OPERATORS, *((q, 1, 1, "Join", statistics(1, 2)) for q in range(1, 8)))
    store = str(tmp_path / "store")
    for day in ("1998-06-28", "1998-06-29", "1998-07-01", "1998-07-01"):
        loaded = m.load_metric_summary(store, history, operators, day)
    days = [str(r[0]) for r in loaded.select("load_date").distinct().orderBy("load_date").collect()]
    assert days == ["1998-06-29", "1998-07-01"]
    assert loaded.where("load_date = date '1998-07-01'").count() == 4


def test_first_day_without_slow_queries_is_an_empty_summary(history, frame, tmp_path):
    operators = frame(OPERATORS, (1, 1, 1, "Join", statistics(1, 2)))
    store = str(tmp_path / "store")
    assert m.load_metric_summary(store, history, operators, "1990-01-01").count() == 0
    assert m.load_metric_summary(store, history, operators, "1998-07-01").count() == 1


def test_statistics_are_parsed_after_the_selection(spark):
    from meterlens.sources.usage_logs import usage_log

    logs = [usage_log(spark, "/root/testdata/sf0.001", n)
            for n in ("query_history", "query_operator_stats")]
    text = plan(m.exploding_counts(*logs, "1998-07-01"))
    assert text.index("from_json") < text.index("LeftSemi")
    assert text.count("from_json(") == text[: text.index("LeftSemi")].count("from_json(")
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text


def test_a_dated_log_is_read_once_and_for_the_windows_only(spark):
    from meterlens.sources.usage_logs import usage_log

    logs = [usage_log(spark, "/root/testdata/sf0.001", n)
            for n in ("query_history", "query_operator_stats")]
    for report in (m.operator_metric_summary, m.union_distinct_counts, m.spill_counts):
        text = plan(report(*logs, "1998-07-01"))
        assert sum("lineitem" in line for line in text.splitlines() if "FileScan" in line) == 1
        scans = [line for line in text.splitlines() if "FileScan" in line and "o_orderdate" in line]
        pushed = r"\(o_orderdate#\d+ >= 1998-06-17 00:00:00\), \(o_orderdate#\d+ < "
        assert sum(re.search(pushed, line) is not None for line in scans) == 1


def test_days_of_the_slow_queries_prune_a_log_kept_by_day(spark, history, frame, at, tmp_path):
    from meterlens.sources.dated import read_dated, write_dated

    operators = frame(OPERATORS, *((q, 1, 1, "Join", statistics(1, 2)) for q in range(1, 8)))
    dated = operators.join(history.select("query_id", "start_time"), "query_id")
    write_dated(dated, str(tmp_path / "log"), "start_time", "errorifexists")
    log = read_dated(spark, str(tmp_path / "log"))
    summary = m.operator_metric_summary(history, log, "1998-07-01")
    assert "dynamicpruning" in plan(summary)
    assert rows(summary.select("query_id", "window"), "query_id") == rows(
        m.operator_metric_summary(history, operators, "1998-07-01").select("query_id", "window"),
        "query_id",
    )


def test_unions_are_found_over_block_bounds(history, frame, monkeypatch):
    random.seed(5)
    kinds = [random.choice(["Aggregate", "UnionAll", "Join", None]) for _ in range(40)]
    steps = [(1, 1 + i % 2, i, kind, "{}") for i, kind in enumerate(kinds)]
    operators = frame(OPERATORS, *random.sample(steps, 40), (1, 1, None, "Aggregate", "{}"))
    expected = sum(a == "Aggregate" and b == "UnionAll" for a, b in zip(["Aggregate", *kinds], kinds))
    for block in (1, 3, 7, 1000):
        monkeypatch.setattr(m, "BLOCK", block)
        counts = m.union_distinct_counts(history, operators, "1998-07-01").select("counts.*").first()
        assert counts["7_days"] == expected

"""Shape of every report's plan."""

import re

import pytest
from conftest import plan

import registry
from meterlens.operators.joins import KEYS_PER_PARTITION, spread_by
from meterlens.plans import operator_metrics

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.all_queries()
# These write or stream before they return a table that is simply read.
EAGER = ("m10_", "i02_", "i03_", "i04_", "i05_", "i06_", "i07_store", "i08_", "a03_")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_no_pairing_no_python_no_table_wide_window(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "EvalPython" not in text and "InPandas" not in text
    if name.startswith("a01_"):  # numbers one count per second
        return
    # A window over everything starts its definition with an order, not with a key.
    assert not re.search(r"windowspecdefinition\([^,]* (?:ASC|DESC) NULLS", text)


@pytest.mark.parametrize(
    "name, column",
    [
        ("q05_costliest_shapes", "o_orderdate"), ("q07_failure_groups", "o_orderdate"),
        ("m11_slowest_queries", "o_orderdate"), ("b01_bill_compute", "l_shipdate"),
        ("b06_bill_storage", "l_shipdate"), ("w01_credit_trend_monthly", "l_shipdate"),
        ("w03_load_minutes", "ts"), ("s01_database_sizes", "l_shipdate"),
        ("s04_org_storage_cost", "l_shipdate"), ("g01_unused_tables", "o_orderdate"),
        ("a01_failure_digest", "ts"), ("a02_has_failures", "ts"),
    ],
)
def test_date_range_is_pushed_to_the_scan(spark, name, column):
    text = plan(QUERIES[name](spark, FOLDER))
    assert re.search(rf"PushedFilters: \[[^\]]*GreaterThanOrEqual\({column}", text) or re.search(
        rf"DataFilters: \[[^\]]*\({column}#\d+L? >=", text
    )


@pytest.mark.parametrize(
    "name", ["q08_latest_per_key", "q07_failure_groups", "b16_tiered_cost", "w01_credit_trend_monthly",
             "s04_org_storage_cost", "i07_audit_rows", "t01_table_reference_counts"],
)
def test_groups_combine_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "partial_" in text


def test_slow_queries_filter_the_operator_log_below_its_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("m03_spill_counts", "m04_spill_queries", "m09_operator_metric_summary"):
            text = plan(QUERIES[name](spark, FOLDER))
            assert re.search(r"Filter [^\n]*array_contains\(Subquery[^\n]*l_orderkey", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_more_slow_queries_than_a_list_holds(spark, monkeypatch):
    listed = QUERIES["m09_operator_metric_summary"](spark, FOLDER).collect()
    monkeypatch.setattr(operator_metrics, "LISTED_IDS", 0)
    joined = QUERIES["m09_operator_metric_summary"](spark, FOLDER)
    assert "array_contains" not in plan(joined) and listed
    assert sorted(map(tuple, listed)) == sorted(map(tuple, joined.collect()))


@pytest.mark.parametrize("name", ["g07_cost_by_tag_all", "g07_cost_by_inherited_tag"])
def test_tables_of_queries_meet_in_a_given_number_of_partitions(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert re.search(r"hashpartitioning\(query_id[^\n]*REPARTITION_BY_NUM", text)


def test_partitions_grow_with_the_keys(spark):
    keys = spark.range(10).withColumnRenamed("id", "k")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread_by(keys, "k", 10).rdd.getNumPartitions() == least
    many = (least + 3) * KEYS_PER_PARTITION
    assert spread_by(keys, "k", many).rdd.getNumPartitions() == least + 3

import datetime as dt

import pytest
from conftest import plan, rows

from meterlens.plans import ingest
from meterlens.sources import pages
from meterlens.sources.dated import newest_value, partition_days
from meterlens.streaming.backup import stream_backup

STARTED = dt.datetime(1998, 7, 1, 6, 0, 0)


def test_attributes_of_mixed_type(frame):
    df = frame(
        "id int, ids string, attributes string",
        (1, "[7,8]", '{"k": 5, "flag": true}'), (2, '["x"]', '{"k": "007", "n": "Yes"}'),
        (3, "[9]", '{"k": "txt", "n": 1.50, "o": {"a": 1}}'), (4, "[9]", '{"k": null}'),
        (5, "[]", '{"k": 1}'), (6, "[9]", None),
    )
    flat = ingest.flatten_attributes(df)
    assert flat.columns == ["id", "individual_id", "flag", "k", "n", "o"]
    assert rows(flat, "id", "individual_id") == [
        (1, "7", "true", "5", None, None), (1, "8", "true", "5", None, None),
        (2, "x", None, "7", "true", None), (3, "9", None, "txt", "1.5", '{"a":1}'),
        (4, "9", None, None, None, None), (6, "9", None, None, None, None),
    ]
    with pytest.raises(ValueError):
        ingest.flatten_attributes(df, max_keys=3)


def test_attribute_keys_may_differ_in_case_only(frame):
    df = frame("id int, ids string, attributes string",
               (1, "[7]", '{"k": 1, "K": "0.123456789012345", "a.b": -0.50}'))
    flat = ingest.flatten_attributes(df)
    assert flat.columns == ["id", "individual_id", "K", "a.b", "k"]
    assert rows(flat) == [(1, "7", "0.123456789012345", "-0.5", "1")]


def test_attribute_numbers_keep_all_digits(frame):
    values = {
        "0.1234567890123456789012": "0.1234567890123456789012", "-007.50": None, "-0.50": "-0.5", "0.000": "0",
        "123456789012345678901234567890123456789012345.50": "123456789012345678901234567890123456789012345.5",
        "1.5e3": "1500", "1e-30": "1e-30", "1E400": "1E400", "25e-1": "2.5", "-0": "0",
        '"00.1234567890123456789012"': "0.1234567890123456789012", '" 7.0 "': "7",
        r'"x\\\": 1, \"5\\"': r'x\": 1, "5' + "\\", '{"a": [1.50, "2.50", 1e3], "b": "\\"1\\""}': '{"a":[1.50,"2.50",1e3],"b":"\\"1\\""}',
    }
    df = frame("id int, ids string, attributes string",
               *((i, "[7]", f'{{"k": {v}, "t": "1, 2]"}}') for i, v in enumerate(values)))
    flat = ingest.flatten_attributes(df)
    found = [r.k for r in flat.orderBy("id").collect()]
    assert found == list(values.values())


def test_attributes_of_many_keys(frame):
    many = "{" + ",".join(f'"k{i:04}":{i}.50' for i in range(1200)) + "}"
    df = frame("id int, ids string, attributes string", (1, "[7,8]", many), (2, "[9]", '{"n": null}'), (3, "[9]", "{}"))
    assert len(ingest.flatten_attributes(df).columns) == 1203
    long = ingest.flatten_attributes_long(df)
    assert long.columns == ["id", "individual_id", "key", "value"]
    expected = [(1, who, f"k{i:04}", f"{i}.5") for who in "78" for i in range(1200)] + [(2, "9", "n", None)]
    assert rows(long, "id", "individual_id", "key") == expected


@pytest.fixture
def log(frame, at):
    def build(*times):
        return frame("id int, t timestamp_ntz", *((i, at(t)) for i, t in enumerate(times)))

    return build


@pytest.mark.parametrize("unit", ["day", "month"])
def test_backup_delta_and_repeat(spark, log, tmp_path, unit):
    path = str(tmp_path / "copy")
    old = ("1998-06-01 10:00:00", "1998-06-01 11:00:00")
    new = ("1998-06-01 11:00:00.5", "1998-06-28 23:59:59", "1998-06-29 00:00:00")
    first = ingest.backup_initial(log(*old), path, "t", "log", STARTED, unit=unit)
    assert [(str(r.run_date), r.row_count) for r in first.collect()] == [("1998-06-01", 2)]
    with pytest.raises(Exception, match="already exists"):
        ingest.backup_initial(log(*old), path, "t", "log", STARTED, unit=unit)
    source = log(*old, *new)
    audit = ingest.backup_delta(source, path, "t", "log", "1998-07-01", STARTED, unit=unit)
    assert [(str(r.run_date), r.row_count) for r in audit.orderBy("run_date").collect()] == [
        ("1998-06-01", 1), ("1998-06-28", 1)
    ]
    again = ingest.backup_delta(source, path, "t", "log", "1998-07-01", STARTED, unit=unit)
    assert again.count() == 0 and spark.read.parquet(path).count() == 4
    assert newest_value(spark, path, "t") == dt.datetime(1998, 6, 28, 23, 59, 59)


def test_empty_copy_loads_unless_strict(spark, log, tmp_path):
    source = log("1998-06-01 10:00:00")
    for strict, loaded in ((True, 0), (False, 1)):
        path = str(tmp_path / f"copy-{strict}")
        assert ingest.backup_initial(source.limit(0), path, "t", "log", STARTED).count() == 0
        audit = ingest.backup_delta(source, path, "t", "log", "1998-07-01", STARTED, strict=strict)
        assert audit.count() == loaded
    # A purge of everything leaves an empty copy, which can be purged and filled again.
    for deleted in (1, 0):
        purged = ingest.purge_older_than(spark, path, "t", "2002-01-01")
        assert rows(purged.select("deleted")) == [(deleted,)]
    audit = ingest.backup_delta(source, path, "t", "log", "1998-07-01", STARTED)
    assert rows(audit.select("row_count")) == [(1,)]


def test_the_audit_counts_the_copy_and_is_stored_once(spark, log, tmp_path):
    path, store = str(tmp_path / "copy"), str(tmp_path / "audit")
    ingest.backup_initial(log("1998-06-01 10:00:00"), path, "t", "log", STARTED)
    log("1998-06-01 10:00:00", "1998-06-02 10:00:00").write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    audit = ingest.backup_delta(source, path, "t", "log", "1998-07-01", STARTED)
    log("1998-06-02 11:00:00").write.mode("append").parquet(str(tmp_path / "source"))
    for _ in range(2):
        ingest.store_audit(audit, store)
    later = ingest.backup_delta(source, path, "t", "log", "1998-07-02", STARTED + dt.timedelta(1))
    ingest.store_audit(later, store)
    stored = spark.read.parquet(store)
    assert sorted(rows(stored.select("load_type", "row_count"))) == [("delta", 1)]


def test_trial_backup_is_one_audit_row(log, tmp_path):
    source = log(*(f"1998-06-{day:02} 00:00:00" for day in range(1, 21)))
    audit = ingest.backup_initial(source, str(tmp_path / "c"), "t", "log", STARTED, limit=5)
    assert [(r.run_date, r.row_count) for r in audit.collect()] == [(STARTED.date(), 5)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_purge_counts_and_keeps_the_rest(spark, log, tmp_path, unit):
    path = str(tmp_path / "copy")
    times = ("1995-05-01 00:00:00", "1995-07-11 23:59:59", "1995-07-12 00:00:00",
             "1995-07-14 23:59:59", "1995-07-15 00:00:00", "1995-07-20 00:00:00",
             "1998-01-01 00:00:00")
    ingest.backup_initial(log(*times), path, "t", "log", STARTED, unit=unit)
    purged = ingest.purge_older_than(spark, path, "t", "1998-07-15")
    assert rows(purged) == [(2, 4)]
    assert [r.t.isoformat(" ") for r in spark.read.parquet(path).orderBy("t").collect()] == list(times[4:])
    assert rows(ingest.purge_older_than(spark, path, "t", "1998-07-15")) == [(0, 0)]
    if unit == "month":
        assert partition_days(spark, path) == [dt.date(1995, 7, 1), dt.date(1998, 1, 1)]
        assert rows(ingest.purge_older_than(spark, path, "t", "1998-07-21")) == [(1, 2)]
        assert partition_days(spark, path) == [dt.date(1998, 1, 1)]


def test_join_and_save_replaces_the_table(frame, tmp_path):
    left = frame("id int, name string, extra int", (1, "a", 0), (2, "b", 0))
    right = frame("id int, value int", (1, 10), (1, 11), (3, 12))
    for _ in range(2):
        saved = ingest.join_and_save(left, right, str(tmp_path / "t"))
    assert rows(saved, "value") == [(1, "a", 10), (1, "a", 11)]


PAGES = "endpoint string, page_no bigint, payload string"


def test_pages_end_at_a_short_page_and_not_at_a_gap(frame):
    df = frame(
        PAGES, ("a", 0, '[{"i":1},{"i":2}]'), ("a", 1, ' {"results":[{"i":3}]}'),
        ("a", 2, '[{"i":4},{"i":5}]'),
        ("b", 0, '{"results":[{"i":6},{"i":7}]}'), ("b", 2, '[{"i":8}]'),
        ("c", 0, '{"error":"x"}'), ("d", 0, "[]"), ("e", 0, "not json"),
        ("f", 0, '[{"i":9},{"i":10}]'),
    )
    found = rows(pages.page_records(df, 2).select("endpoint", "record"))
    assert sorted(found) == sorted(
        [("a", '{"i":1}'), ("a", '{"i":2}'), ("a", '{"i":3}'), ("b", '{"i":6}'), ("b", '{"i":7}'),
         ("b", '{"i":8}'), ("f", '{"i":9}'), ("f", '{"i":10}')]
    )


def test_nested_records_flatten_to_dotted_columns(spark, frame, tmp_path):
    df = frame(
        PAGES, ("/v1/user/", 0, '[{"id":1,"p":{"q":{"r":"x"},"n":null}},{"id":2,"tags":[1,2],"p":{"n":3}}]'),
        ("/v1/none", 0, "[]"),
    )
    flat = pages.flatten_pages(df, "/v1/user/")
    assert sorted(flat.columns) == ["id", "p.n", "p.q.r", "tags"]
    assert sorted(rows(flat.select("id", "`p.q.r`", "`p.n`", "tags"))) == [
        (1, "x", None, None), (2, None, 3, "[1,2]")
    ]
    path = pages.write_endpoint_csv(flat, "/v1/user/", str(tmp_path))
    assert path.endswith("/v1_user.csv")
    assert spark.read.option("header", True).csv(path).count() == 2
    assert pages.flatten_pages(df, "/v1/none") is None
    assert pages.write_endpoint_csv(None, "/v1/none", str(tmp_path)) is None


def test_saved_pages_are_read_whole(spark, frame, tmp_path):
    df = frame(PAGES, ("u", 0, '[\n{"i":1},\n{"i":2}]'), ("u", 1, '[{"i":3}]'))
    df.write.partitionBy("endpoint", "page_no").text(str(tmp_path / "p"))
    saved = pages.read_saved_pages(spark, str(tmp_path / "p"))
    assert rows(pages.flatten_pages(saved, "u", 2), "i") == [(1,), (2,), (3,)]


def test_a_page_is_measured_once_and_not_beside_each_record(spark, frame, tmp_path):
    df = frame(PAGES, ("a", 0, '[{"i":1},{"i":2}]'), ("a", 1, "[5]"), ("a", 2, "[6]"), ("b", 0, "x"))
    df.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    for found in (pages.left_out(df, 2), pages.page_records(df, 2)):
        above, exploded, below = plan(found).partition("Generate posexplode")
        assert exploded and "lengthOfJsonArray" not in above
        assert "lengthOfJsonArray" in below and "BroadcastHashJoin" in below  # served pages only
    assert sorted(rows(pages.left_out(df, 2).select("endpoint", "page_no", "text"))) == [
        ("a", 1, "5"), ("b", 0, None)
    ]


def test_field_names_that_look_like_types_stay(frame):
    df = frame(PAGES, ("a", 0, '[{"VARIANT_ID":5,"AVOIDED":"x","OBJECT":null,"in":{"VOID":[null]}}]'))
    flat = pages.flatten_pages(df, "a")
    assert set(flat.columns) == {"VARIANT_ID", "AVOIDED", "OBJECT", "in.VOID"}
    assert [(r.VARIANT_ID, r.AVOIDED) for r in flat.collect()] == [(5, "x")]


def test_no_endpoint_is_lost_to_odd_records_and_pages(frame):
    df = frame(
        PAGES, ("a", 0, '[{"a":1},{"a":2},5]'), ("a", 1, '{"items":[{"a":9},{"a":9},{"a":9}]}'),
        ("a", 2, '[{"a":3},null,"x"]'), ("b", 0, "{}"), ("c", 0, '{"results":null}'), ("d", 0, "null"),
        ("e", 0, '[1,2]'), ("f", 0, '[{"x":1},{"y":1,"y":2},{"z":1}]'),
    )
    assert rows(pages.flatten_pages(df, "a", 3), "a") == [(1,), (2,), (3,)]
    assert pages.flatten_pages(df, "e", 3) is None
    assert sorted(rows(pages.left_out(df, 3)), key=repr) == sorted(
        [("a", 0, 2, "no readable object", "5"), ("a", 1, None, "unreadable page", None),
         ("a", 2, 1, "no readable object", "null"), ("a", 2, 2, "no readable object", "x"),
         ("e", 0, 0, "no readable object", "1"), ("e", 0, 1, "no readable object", "2"),
         ("f", 0, 1, "no readable object", '{"y":1,"y":2}')], key=repr
    )


def test_names_that_differ_in_case_or_clash_when_dotted(frame):
    df = frame(PAGES, ("a", 0, """[{"k":1,"K":2,"a.b":1,"a":{"b":2,"it's \\"x?\\"":3}},{"a.b":4}]"""))
    flat = pages.flatten_pages(df, "a")
    assert flat.columns == ["K", "a.b", "k", 'a.it\'s "x?"']
    assert rows(flat) == [(2, 2, 1, 3), (None, 4, None, None)]


def test_export_of_all_endpoints(spark, frame, tmp_path):
    df = frame(
        PAGES, ("/v1/a/", 0, '[{"k":1,"K":2},7]'), ("/v1/a/", 1, '{"results":[{"n":{"m":"x,y"}}]}'),
        ("/v1/a/", 2, '[{"late":1}]'), ("v1/a", 0, '[{"other":1}]'), ("/none", 0, "[]"),
        ("/down", 0, "busy"), (None, 0, '[{"i":1}]'),
    )
    summary = rows(pages.export_endpoints(df, str(tmp_path), 2))
    assert sorted(summary, key=repr) == sorted(
        [("/v1/a/", 2, 2, 1, 0, "v1_a.csv"), ("v1/a", 1, 1, 0, 0, "v1_a-2.csv"),
         ("/none", 1, 0, 0, 0, None), ("/down", 0, 0, 0, 1, None), (None, 1, 1, 0, 0, ".csv")], key=repr
    )
    text = sorted(line for f in (tmp_path / "v1_a.csv").glob("part*") for line in f.read_text().split())
    assert text[0] == ',,"x,y"' and text[1] == "2,1," and set(text[2:]) == {"K,k,n.m"}


def test_a_batch_of_one_file_is_written_by_several_tasks(spark, frame, tmp_path, at):
    days = [(i, at(f"1998-{i:02d}-05 06:00:00")) for i in range(1, 13)]
    frame("i int, t timestamp_ntz", *days).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stream = spark.readStream.schema("i int, t timestamp_ntz").parquet(str(tmp_path / "in"))
        run = stream_backup(stream, str(tmp_path / "out"), "t", unit="month")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    copied = list((tmp_path / "out" / "copy").glob("_month=*/_batch=0/part-*.parquet"))
    assert len(copied) == 12 and len({f.name.split("-")[1] for f in copied}) > 1
    assert rows(spark.read.parquet(run.copy).select("i", "t"), "i") == days

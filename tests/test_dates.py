import datetime as dt

from meterlens.functions import dates


def test_full_months_crosses_the_year():
    assert dates.full_months("1998-02-15", 3) == (dt.date(1997, 11, 1), dt.date(1998, 2, 1))


def test_shift_months_clamps_to_the_last_day():
    assert dates.shift_months(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)
    assert dates.shift_months(dt.date(2024, 2, 29), -36) == dt.date(2021, 2, 28)


def test_month_labels_and_column_names():
    labels = dates.month_labels("2024-11-15", "2025-02-01")
    assert labels == ["2024-Nov", "2024-Dec", "2025-Jan"]
    assert dates.short_month("2024-Aug") == "aug_24"


def test_in_months_with_and_without_year(frame, at):
    df = frame(
        "t timestamp_ntz",
        (at("1998-04-30 23:59:59"),), (at("1998-05-01 00:00:00"),), (at("1998-06-30 23:59:59"),),
        (at("1998-12-31 12:00:00"),), (at("1999-05-01 00:00:00"),),
    )
    assert df.where(dates.in_months("t", [6, 5], 1998)).count() == 2
    assert df.where(dates.in_months("t", [12], 1998)).count() == 1
    assert df.where(dates.in_months("t", [5], None)).count() == 2
    assert df.where(dates.in_months("t", None, 1998)).count() == 4
    assert df.where(dates.in_months("t", None, None)).count() == 5


def test_second_number_cuts_fractions(frame, at):
    df = frame("t timestamp_ntz", (at("1970-01-01 00:01:00.900000"),))
    assert df.select(dates.second_number("t")).first()[0] == 60

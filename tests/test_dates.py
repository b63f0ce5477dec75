import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tabwright.functions import dates as grammar
from tabwright.operators import dates

CASES = {
    "mixed": {
        "2024-03-10T02:30:05": "2024-03-10T02:30:05", "2024-03-10T02:30": "2024-03-10T02:30:00",
        "25/12/2024 10:00:00": "2024-12-25T10:00:00", "03/04/2024 10:00": "2024-04-03T10:00:00",
        "12/25/2024 10:00": "2024-12-25T10:00:00", "1/2/2024 3:04": "2024-02-01T03:04:00",
        "31/02/2024 10:00:00": None, "2024-02-30T00:00:00": None, "10/10/2024 24:00:00": None, "10/10/24 10:00": None,
        "2024-01-01": None, "not a date": None, "": None, "2024-01-01T10:00:00\n": None,
    },
    "us12": {
        "8/13/2025 11:00:00 AM": "2025-08-13T11:00:00", "08/13/2025 12:00:00 AM": "2025-08-13T00:00:00",
        "08/13/2025 12:05:00 pm": "2025-08-13T12:05:00", "8/13/2025 1:02:03 PM": "2025-08-13T13:02:03",
        "08/13/2025 00:00:00 AM": None, "08/13/2025 13:00:00 PM": None, "13/08/2025 10:00:00 AM": None,
        "8/13/2025 11:00:00": None, "1,8/13/2025 11:00:00 AM": None, "02/30/2025 01:00:00 AM": None, "": None,
    },
    "mdy": {
        "8/13/2025 11:00:00": "2025-08-13T11:00:00", "8/13/2025": "2025-08-13T00:00:00",
        "1,8/13/2025 11:00:00": "2025-08-13T11:00:00", "13/8/2025": None, "2025-08-13": None,
    },
    "iso": {
        "2025-08-13 11:00:00": "2025-08-13T11:00:00", "2025-08-13T11:00:00": "2025-08-13T11:00:00",
        "2025-08-13": "2025-08-13T00:00:00", "2025-02-29": None, "8/13/2025": None, "2025": None,
    },
    "any": {
        "8/13/2025 11:00:00 AM": "2025-08-13T11:00:00", "1,8/13/2025 11:00:00": "2025-08-13T11:00:00",
        "2025-08-13": "2025-08-13T00:00:00", "x": None,
    },
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("name", list(CASES))
def test_grammars_in_any_zone(spark, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(value,) for value in CASES[name]], "v string")
        found = rows.select("v", grammar.iso_text(grammar.parser(name)(F.col("v"))))
        assert dict(tuple(row) for row in found.collect()) == CASES[name]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_us12_text_round_trip(spark):
    rows = spark.createDataFrame([("2024-03-10 00:05:06",), ("2024-03-10 12:00:00",), ("2024-03-10 23:59:59",)], "v string")
    shown = rows.select(F.translate("v", " ", "T").alias("v"), grammar.us12_text(F.col("v")).alias("us"))
    back = shown.select("v", grammar.iso_text(grammar.parse_us12(F.col("us"))))
    assert all(row[0] == row[1] for row in back.collect())


def test_convert_date_routes_rows(records_of):
    rows = records_of(["id", "when"], [(" a ", "25/12/2024 10:00"), ("b", " "), ("c", "31/02/2024 10:00:00")])
    result = dates.convert_date(rows, "when")
    assert sorted(tuples(result.clean, "id", "when")) == [("a", "2024-12-25T10:00:00"), ("b", "")]
    assert result.clean.columns == ["id", "when", "_row_no"]
    assert tuples(result.rejects, "line", "error_type", "original", "record") == [
        (4, "DATE_CONVERSION_ERROR", "31/02/2024 10:00:00", "c,31/02/2024 10:00:00")
    ]
    assert tuple(result.summary.first())[:3] == (3, 2, 1)
    with pytest.raises(ValueError):
        dates.convert_date(rows, "nope")


def test_convert_all_dates(records_of):
    rows = records_of(["a", "b"], [("25/12/2024", "31/02/2024"), ("1/2/2024", "01/02/2024 ")])
    assert tuples(dates.convert_all_dates(rows), "a", "b", "_converted") == [
        ("2024-12-25", "31/02/2024", 1), ("1/2/2024", "01/02/2024 ", 0)
    ]


US = ["01/02/2024 01:00:00 AM", "bad", "01/02/2024 01:00:00 PM", "01/02/2024 01:00:00 AM", "01/02/2024 01:00:00 PM"]


def test_extremes_take_the_first_of_ties(records_of):
    rows = records_of(["id", "when"], [(str(place), value) for place, value in enumerate(US)])
    oldest, newest = dates.find_oldest(rows, "when").first(), dates.find_newest(rows, "when").first()
    assert (oldest["date"], oldest["line"], oldest["preview"]) == ("2024-01-02T01:00:00", 2, f"0 | {US[0]}")
    assert (newest["date"], newest["line"]) == ("2024-01-02T13:00:00", 4)
    assert (newest["processed"], newest["valid"], newest["invalid"], newest["short_rows"]) == (5, 4, 1, 0)


def test_extremes_without_any_date(records_of):
    found = dates.find_oldest(records_of(["when"], [("x",)]), "when").first()
    assert found["date"] is None and found["line"] is None and found["valid"] == 0


def test_last_by_month(records_of):
    rows = records_of(["when"], [(value,) for value in (
        "01/30/2024 01:00:00 AM", "01/30/2024 02:00:00 AM", "01/30/2024 02:00:00 AM", "05/01/2024 12:00:00 AM", "bad")])
    hit = dates.find_last_by_month(rows, "when", 2024, 1).first()
    assert (hit["found"], hit["matched"], hit["line"], hit["days_away"], hit["side"]) == (True, 3, 3, None, None)
    miss = dates.find_last_by_month(rows, "when", 2024, 2).first()
    # 29 Feb 23:59:59 is 30.9 days after 30 Jan 02:00 and 61 days before 1 May.
    assert (miss["found"], miss["matched"], miss["line"], miss["days_away"], miss["side"]) == (False, 0, 3, 30, "before")
    after = dates.find_last_by_month(rows, "when", 2024, 4).first()
    assert (after["line"], after["days_away"], after["side"]) == (5, 0, "after")
    with pytest.raises(ValueError):
        dates.find_last_by_month(rows, "when", 2024, 13)


def test_latest_and_batches(spark):
    rows = spark.createDataFrame(
        [("a", "1/2/2024"), ("a", "x"), ("b", "1,3/4/2024 10:00:00"), ("c", "")], "_file string, d string")
    assert tuple(dates.find_latest(rows, "d").first()) == ("2024-03-04T10:00:00", 2, 2)
    latest = {row["file"]: row["latest"] for row in dates.find_latest_batch(rows, "d").collect()}
    assert latest == {"a": "2024-01-02T00:00:00", "b": "2024-03-04T10:00:00", "c": None, "TOTAL": "2024-03-04T10:00:00"}
    first = {row["file"]: row["earliest"] for row in dates.find_earliest_batch(rows, "d").collect()}
    assert first["TOTAL"] == "2024-01-02T00:00:00"


@pytest.mark.parametrize("order,expected", [("desc", ["c", "a", "d", "b", "e"]), ("asc", ["a", "d", "c", "b", "e"])])
def test_sort_by_date(records_of, order, expected):
    rows = records_of(["id", "when"], [
        ("a", "01/02/2024 01:00:00 AM"), ("b", "bad"), ("c", "2024-05-05"), ("d", "1/2/2024 1:00:00"), ("e", "")])
    assert [row["id"] for row in dates.sort_by_date(rows, "when", order).collect()] == expected
    numbered = dates.sort_by_date(rows.repartition(3), "when", order, numbered=True)
    assert [row["id"] for row in sorted(numbered.collect(), key=lambda row: row["place"])] == expected


def test_relation_dates(records_of):
    rows = records_of(["f", "g"], [("2024-01-01", ""), ("2024-1-1", "x"), ("2024-99-99 00:00:00", "2024-01-01")])
    result = dates.check_relation_dates(rows, ["f", "g"])
    assert sorted(tuples(result.rejects, "line", "field", "value")) == [(3, "f", "2024-1-1"), (3, "g", "x")]
    assert tuple(result.summary.first()) == (3, 2)


def test_convert_date_rejects_ragged_rows(spark, tmp_path):
    from tabwright.sources import read_records

    (tmp_path / "e.csv").write_text("")
    (tmp_path / "r.csv").write_text("id,when\n1,25/12/2024 10:00\n2\n3,,x\n4,\n")
    rows = read_records(spark, [str(tmp_path / "e.csv"), str(tmp_path / "r.csv")])
    result = dates.convert_date(rows, "when")
    assert sorted(tuples(result.clean, "id", "when")) == [("1", "2024-12-25T10:00:00"), ("4", "")]
    assert sorted(tuples(result.rejects, "line", "error_type", "record")) == [(3, "COLUMN_COUNT", "2"), (4, "COLUMN_COUNT", "3,,x")]
    short = dates.find_oldest(rows, "when").first()
    assert (short["processed"], short["short_rows"]) == (3, 1)

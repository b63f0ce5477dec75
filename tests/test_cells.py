import pytest
from pyspark.sql import functions as F

from tabwright.functions import cells
from tabwright.functions.csvtext import field_count, render_line, split_cells


def verdicts(spark, rule, values):
    rows = spark.createDataFrame([(value,) for value in values], "v string")
    return dict(tuple(row) for row in rows.select("v", rule(F.col("v"))).collect())


SCIENTIFIC = {
    "123": True, "-456": True, "123.456": True, "-789.012": True, "1.23e10": True, "1.23E-5": True,
    "": False, " 123": False, "123 ": False, "1,234": False, "+123": False, "abc": False,
    "12.34.56": False, "--123": False, ".": False, "-": False, "1.": True, ".5": True, "inf": False, "12\n": False,
}
LENIENT = {
    "": True, "  ": True, "12": True, " 12 ": True, '"12"': True, '""': True, '" "': False, "+1": True, "1e5": True,
    ".5": True, "5.": True, "inf": True, "-Infinity": True, "NaN": True, "abc": False, "1,234": False, ".": False,
    "0x1p3": False, "1d": False, "　7\t": True, "12\n": True, "1 2": False,
}
STRICT = {
    "": False, "0": True, "-0": True, "7": True, " 7 ": True, "007": False, "0.5": True, "-12.30": True, "1e3": False,
    "+4": False, "9" * 38: True, "9" * 39: False, "1." + "9" * 37: True, "1." + "9" * 38: False, "1.": False,
}


@pytest.mark.parametrize(
    "rule,cases",
    [
        (cells.is_scientific_number, SCIENTIFIC), (cells.is_lenient_number, LENIENT), (cells.is_strict38_number, STRICT),
        (cells.is_digits, {"12": True, " 12 ": True, "": False, "-1": False, "١": False}),
        (cells.is_int32, {"5": True, "+5": True, "-2147483648": True, "2147483648": False, "": False, "1.0": False,
                          "0000000000000000000005": True, "99999999999999999999": False, " 5": False}),
        (cells.is_int64, {"9223372036854775807": True, "9223372036854775808": False, "x": False}),
        (cells.is_date_shaped, {"2024-13-99": True, "2024-01-01 10:00:00": True, "2024-1-1": False, "": False}),
    ],
)
def test_rules(spark, rule, cases):
    assert verdicts(spark, rule, list(cases)) == cases


def test_trim_covers_unicode_white_space(spark):
    found = verdicts(spark, cells.trim_ws, ["  a b　", "\t x \n", "é ", "", "x"])
    assert list(found.values()) == ["a b", "x", "é", "", "x"]


def test_every_white_space_character_is_trimmed(spark):
    for mark in cells.WHITE_SPACE:
        assert verdicts(spark, cells.trim_ws, [mark + "a" + mark]) == {mark + "a" + mark: "a"}
    assert len(cells.WHITE_SPACE) == 25


def test_unknown_rule():
    with pytest.raises(ValueError):
        cells.number_rule("loose")


def test_field_count_and_split(spark):
    lines = {"a,b": 2, '"a,b",c': 2, '"x""y,z",,': 3, "": 1, ",": 2, '"A, B",1,"C,D"': 3}
    assert verdicts(spark, field_count, list(lines)) == lines
    split = verdicts(spark, split_cells, ['a,"b,c","d""e",', "x", ",x", "", '"a"b,"c,d'])
    assert list(split.values()) == [["a", "b,c", 'd"e', ""], ["x"], ["", "x"], [""], ['"a"b', '"c', "d"]]


def test_render_line(spark):
    row = spark.createDataFrame([("a,b", 'q"q', "12", "", None)], "a string, b string, c string, d string, e string")
    names = row.columns
    assert row.select(render_line(names)).first()[0] == '"a,b","q""q",12,,'
    assert row.select(render_line(names, "non_numeric")).first()[0] == '"a,b","q""q",12,"",""'
    assert row.select(render_line(["d"])).first()[0] == '""'


def test_long_quoted_cells_do_not_overflow(spark):
    long = '1,"' + 'x""y,' * 40000 + '",2'
    many = ",".join(['"a,b"'] * 5000)
    assert list(verdicts(spark, field_count, [long, many]).values()) == [3, 5000]
    assert len(verdicts(spark, split_cells, [many])[many]) == 5000


def test_lenient_pattern_equals_trim_unquote_parse(spark):
    import itertools

    values = ["".join(parts) for size in range(5) for parts in itertools.product(' "1.e', repeat=size)]
    step = F.btrim(cells.trim_ws(F.col("v")), F.lit('"'))
    rows = spark.createDataFrame([(value,) for value in values], "v string")
    same = rows.filter(cells.is_lenient_number(F.col("v")) == ((step == "") | cells.is_float(step)))
    assert same.count() == len(values)

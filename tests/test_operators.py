import random
from collections import Counter

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tabwright.operators import headers, merge, profiles, quality, slices
from tabwright.plans import scale
from tabwright.plans.results import unsound_rows
from tabwright.plans.models import TableModel, get_model, register_model


def test_filter_equals(records_of):
    rows = records_of(["a", "b"], [("x", "1"), ("", "2"), (None, "3"), ("x ", "4")])
    assert [row["b"] for row in slices.filter_equals(rows, "a", "x").collect()] == ["1"]
    assert [row["b"] for row in slices.filter_equals(rows, "a", "").collect()] == ["2", "3"]
    with pytest.raises(ValueError):
        slices.filter_equals(rows, "nope", "x")


FILES = {"one": ["h", "a", "h", "h ", "b"], "two": ["k", "h", "k", "a"], "lone": ["h"]}


@pytest.mark.parametrize("limit", [scale.BROADCAST_BYTES, -1])
def test_repeated_headers_broadcast_or_chunked(lines_of, monkeypatch, limit):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(scale, "CHUNK_LINES", 2)
    lines = lines_of(FILES)
    kept = sorted(tuples(slices.drop_repeated_header(lines), "file", "line_no"))
    assert kept == [("lone", 1), ("one", 1), ("one", 2), ("one", 4), ("one", 5), ("two", 1), ("two", 2), ("two", 4)]
    assert sorted(tuples(slices.repeated_headers(lines), "file", "line_no")) == [("one", 3), ("one", 4), ("two", 3)]
    assert sorted(tuples(profiles.has_repeated_header(lines), "file", "repeats")) == [("one", 2), ("two", 1)]


def test_blank_lines(lines_of):
    lines = lines_of({"f": ["h", "", "  ", ",,,", ", ,", "　", " ,,x", "\t"]})
    kept = [row["line"] for row in slices.drop_blank_lines(lines).orderBy("ord").collect()]
    assert kept == ["h", ", ,", " ,,x"]
    assert tuple(slices.sanitize_text(lines).summary.first()) == (8, 5, 3, 2)


def test_slices(lines_of, records_of):
    lines = lines_of({"f": [f"l{n}" for n in range(1, 9)], "g": ["only"]})
    assert [row["line"] for row in slices.head(lines, 2).filter("file = 'f'").orderBy("ord").collect()] == ["l1", "l2", "l3"]
    for n, expected in [(2, ["l1", "l7", "l8"]), (0, ["l1"]), (99, [f"l{n}" for n in range(1, 9)])]:
        assert [row["line"] for row in slices.tail(lines, n).filter("file = 'f'").orderBy("ord").collect()] == expected
    near = slices.inspect_line(lines.filter("file = 'f'"), 2, 1).orderBy("line_no")
    assert tuples(near, "line_no", "is_target") == [(1, False), (2, True), (3, False)]
    records = records_of(["v"], [(f" {n}\t",) for n in range(1, 6)])
    assert [row["v"] for row in slices.delete_from_row(records, 4).collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        slices.delete_from_row(records, 1)
    assert [row["_chunk_id"] for row in slices.split_chunks(records, 2).collect()] == [1, 1, 2, 2, 3]


def test_long_tail_attaches_lengths(lines_of):
    lines = lines_of({"f": [f"l{n}" for n in range(1, 30)], "g": ["only"]})
    found = [row["line"] for row in slices.tail(lines, 5).orderBy("ord").collect()]
    assert found == ["l1", "l25", "l26", "l27", "l28", "l29", "only"]


def test_merge_against_brute_force(lines_of):
    chance = random.Random(7)
    files = {f"f{n}": [chance.choice("abcdefgh") * chance.randint(1, 2) for _ in range(chance.randint(1, 40))] for n in range(6)}
    lines = lines_of(files).repartition(7)
    top, data = files["f0"][0], [line for body in files.values() for line in body[1:]]
    firsts = list(dict.fromkeys(data))
    merged = merge.merge_dedup(lines, ordered=True).collect()
    assert [row["line"] for row in merged] == [top, *firsts]
    assert Counter(row["line"] for row in merge.merge(lines).collect()) == Counter([top, *data])
    ordered = merge.merge_dedup_sorted(lines).collect()
    assert [row["line"] for row in ordered] == [top, *sorted(firsts)]
    assert profiles.count_unique(lines).first()[0] == len(firsts)
    seen, unique = {top}, {}
    for name, body in files.items():
        new = [line for line in dict.fromkeys(body[1:]) if line not in seen]
        seen.update(new)
        unique[name] = len(new) + (name == "f0")
    found = {row["file"]: tuple(row)[1:] for row in profiles.count_unique(lines, header="first").collect()}
    for name, body in files.items():
        assert found[name] == (len(body), unique[name], len(body) - unique[name])
    total = sum(map(len, files.values()))
    assert found["TOTAL"] == (total, len(seen), total - len(seen))
    assert abs(profiles.count_unique(lines, approximate=True).first()[0] - len(firsts)) <= 1


def test_record_dedup(records_of):
    rows = records_of(["a", "b"], [("a,b", "c"), ("a", "b,c"), ("a,b", "c"), (None, "x"), (None, "x")])
    assert merge.dedup_records(rows.drop("_row_no")).count() == 3
    assert sorted(tuples(merge.dedup_records(rows, "_row_no"), "_row_no")) == [(1,), (2,), (4,)]
    both = merge.merge_records_dedup([rows, records_of(["p", "q"], [("a", "b,c"), ("z", "z")])])
    assert both.columns == ["a", "b"] and both.count() == 4


def test_dedup_by_key(records_of):
    rows = records_of(["k", "s", "v"], [
        ("a#b", "c", "1"), ("a", "b#c", "2"), ("a#b", "c", "3"), ("", "c", "4"), ("x", "", "5"), ("a", "b#c", "6")])
    result = merge.dedup_by_key(rows, ["k", "s"], "_row_no")
    assert sorted(tuples(result.clean, "v")) == [("3",), ("6",)]
    assert sorted(tuples(result.rejects, "line", "error_type")) == [(4, "EMPTY_KEY"), (5, "EMPTY_KEY")]
    assert result.summary.first().asDict() == {"processed": 6, "unique": 2, "errors": 2, "duplicates": 2}
    strict = merge.dedup_by_key(rows, ["k", "s"], "_row_no", strict=True)
    assert strict.clean.count() == 4 and strict.rejects.count() == 0
    first = merge.dedup_by_key(rows, ["k", "s"], "_row_no", keep="first")
    assert sorted(tuples(first.clean, "v")) == [("1",), ("2",)]


def test_dedup_by_key_prunes_before_the_shuffle(records_of):
    clean = merge.dedup_by_key(records_of(["k"], [("a",)]), ["k"], "_row_no").clean
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_compare(lines_of):
    left = lines_of({"f": ["h", "a", "b", "c"]})
    right = lines_of({"f": ["H", "a", "x"]})
    result = merge.compare_first_n(left, right, 100)
    assert sorted(tuples(result.clean, "line_no", "left_value", "right_value")) == [(2, "b", "x"), (3, "c", "")]
    assert tuple(result.summary.first()) == (False, 2)
    assert tuple(merge.compare_first_n(left, right, 1).summary.first()) == (False, 0)
    assert tuple(merge.compare_first_n(left, left, 9).summary.first()) == (True, 0)


def test_compare_joins_only_runs_that_differ(spark):
    left = spark.range(2000).select(F.col("id").alias("line_no"), F.concat(F.lit("v"), F.col("id") % 7).alias("line"))
    changed = F.when(F.col("line_no").isin(5, 1203), F.lit("new")).when(F.col("line_no") == 640, F.lit(None)).otherwise(F.col("line"))
    right = left.withColumn("line", changed).filter("line_no <> 1999")
    for extra in (False, True):
        if extra:
            # Without a position nothing can be compared, so each side shows its row.
            left, right = (df.unionByName(spark.createDataFrame([(None, "x")], "line_no long, line string")) for df in (left, right))
        plain = merge.compare(left, right, "line_no", "line")
        runs = merge.compare(left, right, "line_no", "line", exact=False, run=100)
        assert sorted(map(str, runs.collect())) == sorted(map(str, plain.collect()))
        assert runs.count() == (6 if extra else 4)
    # Four of twenty runs differ: as many rows of each side are joined, the others stay where they are.
    differing = merge.differing_runs(left, right, "line_no", "line", 100).filter("_run IS NOT NULL")
    assert sorted(row["_run"] for row in differing.collect()) == [0, 6, 12, 19]
    assert merge._rows_of_runs(left, differing, "line_no", 100, True).count() == 401
    same = merge.compare(left, left.filter("line_no >= 0"), "line_no", "line", exact=False, run=100)
    assert same.collect() == [(None, "x", "")]
    met = merge._rows_of_runs(left.filter("line_no >= 0"), differing.filter("_run < 0"), "line_no", 100, True)
    assert met.count() == 0


MODEL = TableModel(
    name="sample", columns=("K", "S", "N", "D"), keys=("K", "S"), numeric=("K", "N"),
    kinds={"K": "int64", "S": "int32", "N": "decimal", "D": "date_shape"},
)


def test_headers(lines_of):
    files = {
        "ok": ["K,S,N,D", "1,2,3,"], "none": ["1,2,3,", "4,5,6,"], "twice": ["K,S,K", "x"],
        "other": ["K,S,N,E"], "quoted": ['"K","S","N","D"'],
    }
    lines = lines_of(files)
    found = {row["file"]: row.asDict() for row in headers.check_header(lines, MODEL).collect()}
    assert found["ok"]["status"] == "ok" and found["ok"]["records"] == 1
    assert found["quoted"]["status"] == "ok" and found["quoted"]["records"] == 0
    assert (found["twice"]["status"], found["twice"]["duplicates"]) == ("duplicate", "K")
    assert (found["other"]["status"], found["other"]["missing"], found["other"]["extra"]) == ("mismatch", "D", "E")
    plain = {row["file"]: row["status"] for row in headers.check_header(lines).collect()}
    assert plain == {"ok": "ok", "none": "ok", "twice": "duplicate", "other": "ok", "quoted": "ok"}
    lacking = {row["file"] for row in headers.detect_missing_header(lines).collect() if row["missing_header"]}
    assert lacking == {"none"}
    expected = {row["file"]: row["missing_header"] for row in headers.detect_missing_header(lines, "K,S,N,D").collect()}
    assert expected == {"ok": False, "none": True, "twice": True, "other": True, "quoted": True}
    added = headers.add_header(lines, MODEL).filter("file = 'none'").orderBy("line_no")
    assert tuples(added, "line_no", "line", "header_added") == [(1, "K,S,N,D", True), (2, "1,2,3,", True), (3, "4,5,6,", True)]
    assert headers.add_header(lines, MODEL).filter("file <> 'none'").count() == 6


def test_batch_add_headers(spark, lines_of, tmp_path):
    lines = lines_of({"/in/a.csv": ["1,2,3,", "4,5,6,"], "/in/b.csv": ["K,S,N,D", "7,8,9,"], "/in/c.csv": ["P,Q,R,T", "x,y,z,"]})
    foreign = headers.batch_add_headers(lines, MODEL, str(tmp_path / "out"))
    assert tuples(foreign, "file", "header") == [("/in/c.csv", "P,Q,R,T")]
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(tuples(back, "file_name", "K", "N")) == [("a.csv", "1", "3"), ("a.csv", "4", "6"), ("b.csv", "7", "9")]


ROWS = [("1", "2", "3.5", "2024-01-01"), ("x", "2", "", ""), ("3", "2.5", "+4", "1/1/24"), (" 4 ", "7", "007", ""), ("", "1", "nan", "")]


def test_sanitize(records_of):
    rows = records_of(list(MODEL.columns), ROWS)
    lenient = quality.sanitize_for_import(rows, MODEL)
    assert sorted(tuples(lenient.clean, "_row_no")) == [(1,), (3,), (4,), (5,)]
    assert tuples(lenient.rejects, "line", "field", "value", "table_key", "record") == [
        (3, "K", "x", "{K=x,S=2}", "x,2,,")]
    strict = quality.sanitize_for_import(rows, MODEL, rule="strict38")
    assert sorted(tuples(strict.clean, "_row_no", "K")) == [(1, "1")]
    kinds = Counter((row["line"], row["error_type"], row["field"]) for row in strict.rejects.collect())
    assert kinds == Counter({
        (3, "INVALID_NUMERIC", "K"): 1, (3, "INVALID_NUMERIC", "N"): 1, (3, "SKIPPED", None): 1,
        (4, "INVALID_NUMERIC", "N"): 1, (4, "SKIPPED", None): 1, (5, "INVALID_NUMERIC", "N"): 1, (5, "SKIPPED", None): 1,
        (6, "INVALID_NUMERIC", "K"): 1, (6, "INVALID_NUMERIC", "N"): 1, (6, "SKIPPED", None): 1,
    })
    summary = strict.summary.first()
    assert (summary["processed"], summary["valid"], summary["invalid_numeric"], summary["irreparable"]) == (5, 1, 4, 0)
    assert summary["valid_percent"] == 20.0
    with pytest.raises(ValueError):
        quality.sanitize_for_import(rows.drop("D"), MODEL)
    narrow = quality.sanitize_for_import(rows, MODEL, rule="strict38", expected_width=5)
    assert narrow.clean.count() == 0 and narrow.summary.first()["irreparable"] == 5
    empty = quality.sanitize_for_import(rows.limit(0), MODEL).summary.first()
    assert (empty["processed"], empty["valid_percent"]) == (0, 0.0)


def test_audits(records_of):
    rows = records_of(list(MODEL.columns), ROWS * 30)
    full = quality.audit_numeric(rows, MODEL, rule="scientific").rejects
    capped = quality.audit_numeric(rows, MODEL, rule="scientific", cap=20)
    counts = Counter(row["field"] for row in full.collect())
    assert counts == {"K": 60, "N": 90}
    first = sorted((row["line"], row["field"]) for row in full.collect())[:20]
    assert sorted((row["line"], row["field"]) for row in capped.rejects.collect()) == first
    assert capped.summary.first()["processed"] == 150
    assert tuples(quality.field_error_counts(rows, MODEL), "field", "errors") == [("N", 90), ("K", 60)]
    audit = quality.audit_schema(rows, MODEL)
    assert audit.summary.first()["errors"] == 180


def test_validate_model(records_of):
    rows = records_of(list(MODEL.columns), ROWS)
    result = quality.validate_model(rows, MODEL)
    found = sorted(tuples(result.rejects, "line", "field", "details"))
    assert found == [
        (3, "K", "K is no 64-bit integer: x"), (3, "N", "N is no decimal number: "),
        (4, "D", "D is no ISO date: 1/1/24"),
        (4, "S", "S is no 32-bit integer: 2.5"), (5, "K", "K is no 64-bit integer:  4 "),
        (6, "K", "K is no 64-bit integer: "),
    ]
    summary = result.summary.first()
    assert (summary["processed"], summary["valid"], summary["errors"], summary["errors_percent"]) == (5, 1, 6, 120.0)
    assert quality.validate_model(rows, MODEL, max_show=2).rejects.count() == 2
    with pytest.raises(ValueError):
        quality.validate_model(rows.withColumnRenamed("D", "E"), MODEL)


def test_ragged_records(spark, tmp_path):
    from tabwright.sources import read_records

    path = tmp_path / "r.csv"
    path.write_text("K,S,N,D\n1,2,3,\n1,2\n1,2,3,4,5\n")
    rows = read_records(spark, str(path))
    result = quality.drop_ragged(rows)
    assert result.clean.count() == 1
    assert sorted(tuples(result.rejects, "line", "error_type", "details", "record")) == [
        (3, "ColumnMismatch", "2 cells under 4 columns", "1,2"), (4, "ColumnMismatch", "5 cells under 4 columns", "1,2,3,4,5")]
    assert sorted(tuples(quality.sanitize_for_import(rows, MODEL).rejects, "line", "error_type")) == [
        (3, "COLUMN_COUNT"), (4, "COLUMN_COUNT")]
    assert sorted(tuples(quality.sanitize_for_import(rows, MODEL, rule="strict38").rejects, "error_type")) == [
        ("IRREPARABLE_STRUCTURE",), ("IRREPARABLE_STRUCTURE",)]
    assert sorted(tuples(quality.validate_model(rows, MODEL).rejects, "error_type")) == [("ColumnCount",), ("ColumnCount",)]
    dedup = merge.dedup_by_key(rows, ["K"], "_row_no")
    assert sorted(tuples(dedup.rejects, "line", "error_type")) == [(2, "LENGTH_MISMATCH"), (3, "LENGTH_MISMATCH")]


def test_keys_and_reports(records_of, lines_of):
    names = ["IdCliente", "IdTransmit", "NroDoc", "Cuil"]
    rows = records_of(names, [("1", "+02", "D", "20"), ("x", "2", "E", " "), ("3", "9999999999", "F", "2a")])
    assert tuples(quality.extract_resume_key(rows).clean, "record", "resume_key") == [(1, "{IdCliente=1,IdTransmit=2,NroDoc=D}")]
    assert sorted(tuples(quality.extract_resume_key(rows).rejects, "record", "error_type")) == [
        (2, "IdCliente is no 32-bit integer"), (3, "IdTransmit is no 32-bit integer")]
    keys = quality.extract_keys(rows, TableModel("t", tuple(names), ("Cuil",)), limit=2)
    assert keys.summary.first()["processed"] == 3
    assert tuples(keys.clean, "record", "key") == [(1, "{Cuil=20}"), (2, "{Cuil= }")]
    missing = quality.find_missing_key(rows, "Cuil")
    assert tuples(missing.rejects, "_row_no") == [(2,)] and tuple(missing.summary.first()) == (3, 1)
    assert tuples(quality.find_invalid_numeric(rows, ["Cuil", "IdTransmit"], max_report=2), "line", "field", "value") == [
        (2, "IdTransmit", "+02"), (3, "Cuil", " ")]
    checked = quality.check_numeric_keys(rows, TableModel("t", tuple(names), ("Cuil",)))
    assert sorted(tuples(checked.rejects, "line", "error_type")) == [(3, "EMPTY_KEY"), (4, "NON_DIGIT_KEY")]
    lines = lines_of({"f": ["é" * 5, "x" * 9, "ab"]})
    assert tuples(quality.find_oversize(lines, 9), "line_no", "bytes") == [(1, 10)]
    assert tuples(quality.find_oversize(lines, 1, max_report=2), "line_no", "total") == [(1, 3), (2, 3)]
    assert quality.find_oversize(lines, 1).count() == 3


@pytest.fixture
def broken(spark, tmp_path):
    """Width 2: sound, long, long, short, half of a quoted break, its other half, sound."""
    from tabwright.sources import read_records

    path = tmp_path / "broken.csv"
    path.write_text('a,b\n1,2\n1,2,x\n1,2,y\n7\n1,"c\nd"\n1,3\n')
    return read_records(spark, str(path))


def test_unsound_records_stay_out_of_every_job(broken):
    assert sorted(tuples(slices.filter_equals(broken, "a", "1"), "a", "b")) == [("1", "2"), ("1", "3")]
    assert sorted(tuples(merge.dedup_records(broken), "a", "b")) == [("1", "2"), ("1", "3")]
    assert sorted(tuples(merge.merge_records_dedup([broken, broken]), "a", "b")) == [("1", "2"), ("1", "3")]
    assert slices.delete_from_row(broken, 6).count() == 1
    assert sorted(tuples(unsound_rows(broken), "line", "error_type")) == [
        (3, "COLUMN_COUNT"), (4, "COLUMN_COUNT"), (5, "COLUMN_COUNT"), (6, "PARSE_ERROR"), (7, "COLUMN_COUNT")]
    keys = quality.extract_keys(broken, TableModel("t", ("a", "b"), ("a", "b")))
    assert sorted(tuples(keys.clean, "record", "key")) == [(1, "{a=1,b=2}"), (7, "{a=1,b=3}")] and keys.rejects.count() == 5


@pytest.mark.parametrize("job", [
    lambda rows: slices.filter_equals(rows, "a", "1", strict=True),
    lambda rows: merge.dedup_records(rows, strict=True),
    lambda rows: merge.merge_records_dedup([rows], strict=True),
    lambda rows: merge.dedup_by_key(rows, ["a"], "_row_no", strict=True).clean,
])
def test_strict_jobs_fail_on_unsound_records(broken, job):
    with pytest.raises(Exception, match="does not fit its header"):
        job(broken).collect()


def test_error_counts_skip_cells_that_are_not_there(spark, tmp_path):
    from tabwright.sources import read_records

    path = tmp_path / "short.csv"
    path.write_text("K,S,N,D\n5\nx,1,y,\n")
    counts = quality.field_error_counts(read_records(spark, str(path)), MODEL)
    assert tuples(counts, "field", "errors") == [("K", 1), ("N", 1)]


def test_compare_first_n_reads_each_side_once(lines_of):
    left, right = lines_of({"l": ["h", "a", "b"]}), lines_of({"r": ["H", "a"]})
    result = merge.compare_first_n(left, right, 5)
    assert tuple(result.summary.first()) == (False, 1)
    assert tuples(result.clean, "line_no", "left_value", "right_value") == [(2, "b", "")]
    plan = result.summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2


def test_registry():
    assert get_model("MOROSOS").width == 14
    assert [get_model(name).width for name in ("personas_telefonos", "personas_telefonos_cuil", "empleadores", "empleadores_relaciones")] == [13, 6, 7, 4]
    register_model(get_model("empleadores").renamed("Mine"))
    assert get_model("mine").keys == ("Cuit",)
    with pytest.raises(ValueError):
        get_model("nope")
    with pytest.raises(ValueError):
        TableModel("t", ("a",), ("b",))


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_results_do_not_depend_on_partitions(lines_of, parts):
    lines = lines_of({f"f{n}": ["h"] + [f"v{(n * k) % 11}" for k in range(50)] for n in range(5)}).repartition(parts)
    assert merge.merge_dedup(lines).agg(F.sum("ord"), F.count("*")).first() == (
        merge.merge_dedup(lines.coalesce(1)).agg(F.sum("ord"), F.count("*")).first())
    assert slices.tail(lines, 3).count() == 20
    numbered = scale.number_rows(lines, [F.asc("ord")], "place").agg(F.max("place"), F.countDistinct("place"))
    assert tuple(numbered.first()) == (255, 255)


def test_a_hot_key_keeps_results_whole(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"), (F.col("id") + 1).alias("_row_no"))
    result = merge.dedup_by_key(rows, ["k"], "_row_no")
    assert result.clean.count() == 20001
    assert result.clean.filter("k = 'hot'").first()["v"] == "29997"
    assert result.summary.first()["duplicates"] == 9999


def test_odd_column_names_survive(records_of, tmp_path):
    rows = records_of(["_id", "a.b", "c d"], [("1", "x", "y"), ("1", "x", "y"), ("2", "x", "z")])
    assert merge.dedup_records(rows.drop("_row_no")).columns == ["_id", "a.b", "c d"]
    assert merge.merge_records_dedup([rows, rows]).count() == 2
    kept = merge.dedup_by_key(rows, ["a.b"], "_row_no").clean
    assert tuples(kept, "_id", "`c d`") == [("2", "z")]
    assert [row["_id"] for row in slices.delete_from_row(rows, 3).collect()] == ["1"]


def test_check_header_on_wide_lines(lines_of):
    names = [f"c{n}" for n in range(20000)]
    lines = lines_of({"wide": [",".join([*names, "c7", "c7", "b"])], "one": ["x"], "empty": [""]})
    found = {row["file"]: row for row in headers.check_header(lines).collect()}
    assert (found["wide"]["duplicates"], found["wide"]["n_columns"]) == ("c7", 20003)
    assert found["one"]["status"] == "ok" and found["empty"]["n_columns"] == 1

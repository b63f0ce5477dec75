"""Quoted line breaks in files that split, and bytes that cannot be decoded."""

import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.operators import dates, merge, quality, slices
from tabwright.plans.results import sound_rows, unsound_rows
from tabwright.sources import quoted, read_lines, read_records


def cells_of(seed, count):
    pick = random.Random(seed)
    bits = ["a", "b c", '"', ",", "\n", "\r\n", "\n\n", '""', "é", "x" * 30, ""]
    return [(str(place), "".join(pick.choices(bits, k=pick.randint(0, 9))), pick.choice(["", "z", '"', "1\n2"])) for place in range(count)]


def written(path, rows, ending="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=ending).writerows(rows)
    path.write_bytes(out.getvalue().encode("utf-8"))
    return str(path)


@pytest.mark.parametrize("split", [64, 300, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_are_those_of_a_csv_reader(spark, tmp_path, split, ending):
    rows, more = cells_of(split, 120), cells_of(split + 1, 30)
    paths = [written(tmp_path / "a.csv", [("id", "text", "tail"), *rows], ending), written(tmp_path / "b.csv", [("id", "text", "tail"), *more], ending)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = read_records(spark, paths, quoted_breaks=True)
        got = [tuple(row) for row in found.orderBy("_ord").select("id", "text", "tail", "_row_no", "_corrupt", "_n_fields").collect()]
        tasks = found.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(*row, place, None, 3) for table in (rows, more) for place, row in enumerate(table, start=1)]
    assert got == want
    assert split > 300 or tasks > 2


def plain_states(text):
    """State at the beginning of each line, character by character."""
    states, inside, at_cell, place = [False], False, True, 0
    while place < len(text):
        char = text[place]
        if inside:
            if char == '"':
                if text[place + 1 : place + 2] == '"':
                    place += 1
                else:
                    inside = False
        elif char == '"' and at_cell:
            inside = True
        at_cell = not inside and char in ",\n"
        place += 1
        if char == "\n":
            states.append(inside)
    return states


def test_line_states_against_a_walk_over_the_characters():
    pick = random.Random(7)
    for _ in range(400):
        text = "".join(pick.choices('ab,"\n', [3, 3, 3, 4, 2], k=pick.randint(0, 60)))
        lines, state, got = text.split("\n"), False, [False]
        for line in lines:
            state = quoted.ends_inside(line.encode(), state)
            got.append(state)
        assert got[: len(lines)] == plain_states(text)[: len(lines)], text


def test_block_sums_hold_for_both_beginnings():
    text = 'x,"a\n\nb",c\nplain\n\n"open\nstill, here\n'.split("\n")[:-1]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["f"] * len(text)), pa.array([0] * len(text), pa.int64()), pa.array([line.encode() for line in text], pa.binary())],
        ["_file", "_block", "_data"])
    # The same block in one batch and line by line.
    for batches in ([batch], [batch.slice(place, 1) for place in range(len(text))]):
        rows = [row for one in quoted.block_sums(iter(batches)) for row in one.to_pylist()]
        assert len(rows) == 1
        assert (rows[0]["_end_out"], rows[0]["_records_out"]) == (True, 3)
        states, inside, starts = [], True, 0
        for line in text:
            starts += (not inside) and line != ""
            inside = quoted.ends_inside(line.encode(), inside)
        assert (rows[0]["_end_in"], rows[0]["_records_in"]) == (inside, starts)


def test_middle_lines_are_never_records(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b,c\n1,"x\nmid,dle,z\nend",2\n3,4,5\n6,"open\n7,8,9\n')
    found = read_records(spark, str(tmp_path / "m.csv"), quoted_breaks=True)
    clean = quality.drop_ragged(found)
    assert [tuple(row) for row in clean.clean.orderBy("_row_no").select("a", "b", "c").collect()] == [("1", "x\nmid,dle,z\nend", "2"), ("3", "4", "5")]
    # What a quote leaves open to the end of the file is one broken record.
    assert [row["record"] for row in clean.rejects.collect()] == ['6,"open\n7,8,9']


def test_empty_and_blank_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text("a,b\n\n\r\n1,2\n\n")
    found = read_records(spark, [str(tmp_path / "e.csv"), str(tmp_path / "f.csv")], quoted_breaks=True)
    assert [(row["a"], row["b"], row["_row_no"]) for row in found.collect()] == [("1", "2", 1)]
    with pytest.raises(ValueError, match="multi_line"):
        read_records(spark, str(tmp_path / "f.csv"), multi_line=True, quoted_breaks=True)


@pytest.fixture
def garbled(tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes(b"id,name\n1,Mu\xf1oz\n1,Mu\xe9oz\n1,Mu\xf1oz\n2,x\n3,a,\xff\n4,Z\xc3\xa9\r\n5,\xf1\r\n")
    return str(path)


def test_undecodable_records_are_rejects_in_hex(spark, garbled):
    for options in ({}, {"quoted_breaks": True}):
        records = read_records(spark, garbled, **options)
        assert {(row["id"], row["name"]) for row in merge.dedup_records(records).collect()} == {("2", "x"), ("4", "Zé")}
        rejects = unsound_rows(records).orderBy("line").collect()
        assert [(row["line"], row["error_type"]) for row in rejects] == [(2, "ENCODING_ERROR"), (3, "ENCODING_ERROR"), (4, "ENCODING_ERROR"), (6, "ENCODING_ERROR"), (8, "ENCODING_ERROR")]
        # Different bytes stay different.
        assert [bytes.fromhex(row["record"]) for row in rejects] == [b"1,Mu\xf1oz", b"1,Mu\xe9oz", b"1,Mu\xf1oz", b"3,a,\xff", b"5,\xf1"]
        result = quality.drop_ragged(records)
        assert result.summary.select("valid", "invalid").first() == (2, 5)
        assert {row["error_type"] for row in result.rejects.collect()} == {"EncodingError"}
        assert merge.merge_records_dedup([records, records]).count() == 2


def test_undecodable_records_keep_their_numbers(spark, garbled):
    records = read_records(spark, garbled)
    kept = slices.delete_from_row(records, 8)
    assert [(row["_row_no"], row["name"]) for row in kept.orderBy("_row_no").collect()] == [(4, "x"), (6, "Zé")]
    assert sound_rows(records).count() == 2
    with pytest.raises(Exception, match="UTF-8"):
        read_records(spark, garbled, strict=True).collect()
    found = dates.convert_date(records, "name").rejects
    assert found.where("error_type = 'ENCODING_ERROR'").count() == 5


def test_charset_decodes_the_bytes(spark, garbled):
    found = read_records(spark, garbled, charset="ISO-8859-1")
    assert [row["name"] for row in sound_rows(found).orderBy("_row_no").collect()] == ["Muñoz", "Muéoz", "Muñoz", "x", "ZÃ©", "ñ"]
    assert read_lines(spark, garbled, charset="ISO-8859-1").where(F.col("line") == "1,Muñoz").count() == 2
    assert read_lines(spark, garbled).select(F.hex(F.col("line").cast("binary")).alias("h")).where("h = '352CF1'").count() == 1
    with pytest.raises(ValueError, match="told apart"):
        read_lines(spark, garbled, charset="utf-16")

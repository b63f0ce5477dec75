import os

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tabwright.operators import merge, profiles, slices
from tabwright.sources import (
    file_list, first_line, normalize_header, read_lines, read_manifest, read_records,
    write_chunks, write_lines, write_records, write_rejects,
)
from tabwright.plans import scale
from tabwright.sources import lines as source


def put(folder, name, content):
    path = folder / name
    path.write_bytes(content.encode() if isinstance(content, str) else content)
    return str(path)


def part_texts(folder):
    return [
        open(os.path.join(root, name), encoding="utf-8").read()
        for root, _, names in os.walk(folder) for name in sorted(names) if name.startswith("part-")
    ]


def test_lines_crlf_bom_and_missing_last_newline(spark, tmp_path):
    path = put(tmp_path, "a b+1%20.csv", b"\xef\xbb\xbfh1,h2\r\n1,x\ry\r\n\r\n2,z")
    found = read_lines(spark, path).orderBy("line_no").collect()
    assert [(row["line_no"], row["line"]) for row in found] == [(1, "h1,h2"), (2, "1,x\ry"), (3, ""), (4, "2,z")]
    assert {row["file_lines"] for row in found} == {4}


@pytest.fixture
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    spark.conf.set(keys[0], "700b")
    spark.conf.set(keys[1], "16b")
    yield
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


@pytest.mark.parametrize("limit", [scale.BROADCAST_BYTES, 0])
def test_numbers_over_many_blocks_and_files(spark, tmp_path, small_blocks, monkeypatch, limit):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
    sizes = {"z.csv": 900, "a.csv": 37, "m.csv": 400, "one.csv": 1, "none.csv": 0}
    paths = [put(tmp_path, name, "".join(f"{name}:{place}\n" for place in range(1, size + 1)))
             for name, size in sizes.items()]
    assert source.scan_lines(spark, paths[:1]).select("_block").distinct().count() > 5
    lines = read_lines(spark, paths)
    found = lines.select("file_ord", "line_no", "line", "ord", "file_lines", "top_file").collect()
    assert len(found) == sum(sizes.values())
    names = list(sizes)
    for row in found:
        assert row["line"] == f"{names[row['file_ord']]}:{row['line_no']}"
        assert row["ord"] == (row["file_ord"] << 40) + row["line_no"]
        assert row["file_lines"] == sizes[names[row["file_ord"]]]
        assert row["top_file"] == (row["file_ord"] == 0)
    counts = profiles.count_by_file(lines, files=file_list(spark, paths)).collect()
    assert {row["file"].rsplit("/", 1)[-1]: row["lines"] for row in counts} == sizes | {"TOTAL": sum(sizes.values())}
    for whole in (True, False):
        last = slices.tail(lines, 2, whole_files=whole).select("line").collect()
        assert sorted(row["line"] for row in last if row["line"].startswith("m.")) == ["m.csv:1", "m.csv:399", "m.csv:400"]


def test_a_file_listed_twice_is_read_twice(spark, tmp_path):
    path = put(tmp_path, "a.csv", "h\n1\n")
    found = read_lines(spark, [path, path]).select("file_ord", "line").collect()
    assert sorted(map(tuple, found)) == [(0, "1"), (0, "h"), (1, "1"), (1, "h")]
    assert merge.merge(read_lines(spark, [path, path])).count() == 3


def test_an_empty_first_file_does_not_take_the_header(spark, tmp_path):
    paths = [put(tmp_path, "e.csv", ""), put(tmp_path, "a.csv", "h\n1\n"), put(tmp_path, "b.csv", "h\n2\n")]
    lines = read_lines(spark, paths)
    assert sorted(row["line"] for row in merge.merge(lines).collect()) == ["1", "2", "h"]
    assert first_line(lines) == "h"


def test_manifest(spark, tmp_path):
    path = put(tmp_path, "list.txt", "\ufeff# header\n /b.csv \n\n/a.csv\r\n#x\n/c.csv")
    assert read_manifest(spark, path) == ["/b.csv", "/a.csv", "/c.csv"]


RAGGED = 'a,b,c\n1,"x, y",3\n2,only\n\n3,"q ""z""", s \n4,1,2,3\n5,"",\n'


def test_records_keep_ragged_rows(spark, tmp_path):
    rows = read_records(spark, put(tmp_path, "r.csv", RAGGED)).orderBy("_row_no").collect()
    assert [(row["a"], row["b"], row["c"], row["_row_no"], row["_n_fields"], row["_corrupt"]) for row in rows] == [
        ("1", "x, y", "3", 1, 3, None),
        ("2", "only", "", 2, 2, "2,only"),
        ("3", 'q "z"', " s ", 3, 3, None),
        ("4", "1", "2", 4, 4, "4,1,2,3"),
        ("5", "", "", 5, 3, None),
    ]


def test_records_strict_and_trim(spark, tmp_path):
    path = put(tmp_path, "r.csv", RAGGED)
    with pytest.raises(Exception):
        read_records(spark, path, strict=True).collect()
    trimmed = read_records(spark, path, trim=True).filter("a = '3'").first()
    assert trimmed["c"] == "s"
    whole = read_records(spark, put(tmp_path, "ok.csv", "a,b\n1,2\n"), strict=True)
    assert tuples(whole, "a", "b") == [("1", "2")]


def test_records_without_header_and_with_quoted_breaks(spark, tmp_path):
    path = put(tmp_path, "n.csv", "1,x\n2,y\n")
    assert sorted(tuples(read_records(spark, path, header=False), "c1", "c2", "_row_no")) == [("1", "x", 1), ("2", "y", 2)]
    broken = put(tmp_path, "m.csv", 'a,b\n1,"two\nlines"\n2,y\n3\n')
    other = put(tmp_path, "n2.csv", "a,b\n9,z\n")
    rows = read_records(spark, [broken, other], multi_line=True)
    assert sorted(tuples(rows, "a", "b", "_row_no", "_n_fields")) == [
        ("1", "two\nlines", 1, 2), ("2", "y", 2, 2), ("3", "", 3, 1), ("9", "z", 1, 2)]


def test_each_file_has_its_own_header_line(spark, tmp_path):
    paths = [put(tmp_path, "b.csv", "a,b\n1,2\n"), put(tmp_path, "a.csv", "a,b\n3,4\n5,6\n")]
    rows = read_records(spark, paths)
    assert sorted(tuples(rows, "a", "_row_no")) == [("1", 1), ("3", 1), ("5", 2)]
    assert [row["a"] for row in rows.orderBy("_ord").collect()] == ["1", "3", "5"]


def test_written_records_come_back(spark, records_of, tmp_path):
    cells = [(" lead", 'q"q', "a,b"), ("#not a comment", "", "tail "), ("12", "-3.5", "x")]
    rows = records_of(["a", "b c", 'd"e'], cells)
    write_records(rows.coalesce(1), str(tmp_path / "out"))
    texts = part_texts(tmp_path / "out")
    assert texts == ['a,b c,"d""e"\n lead,"q""q","a,b"\n#not a comment,,tail \n12,-3.5,x\n']
    back = read_records(spark, str(tmp_path / "out"))
    assert sorted(tuples(back, "a", "b c", '`d"e`')) == sorted(cells)


def test_non_numeric_quoting(records_of, tmp_path):
    write_records(records_of(["a", "b"], [("12", "x"), ("", "1e5")]).coalesce(1), str(tmp_path / "out"), quote="non_numeric")
    assert part_texts(tmp_path / "out") == ['"a","b"\n12,"x"\n"",1e5\n']


def test_rejects_lines_and_chunks(spark, records_of, tmp_path):
    rejects = spark.createDataFrame(
        [(2, "TypeError", "Invalid X: a,b", "{K=1}", "INVALID_SQL_KEY")],
        "line bigint, error_type string, details string, table_key string, resume_key string")
    write_rejects(rejects, str(tmp_path / "log"))
    assert 'Line,ErrorType,Details,DynamoDbKey,SqlCompositeKey\n2,TypeError,"Invalid X: a,b",{K=1},INVALID_SQL_KEY\n' in part_texts(
        tmp_path / "log")
    raw = ['#x,"', " y ", "a,b"]
    write_lines(spark.createDataFrame([(line,) for line in raw], "line string").coalesce(1), str(tmp_path / "raw"), "h,i")
    assert part_texts(tmp_path / "raw") == ['h,i\n#x,"\n y \na,b\n']
    chunked = slices.split_chunks(records_of(["v"], [(str(n),) for n in range(1, 6)]), 2)
    write_chunks(chunked, str(tmp_path / "chunks"), "out")
    found = spark.read.option("header", True).csv(str(tmp_path / "chunks"))
    assert sorted(tuples(found, "chunk", "v")) == [
        ("out_001", "1"), ("out_001", "2"), ("out_002", "3"), ("out_002", "4"), ("out_003", "5")]


def test_normalize_header(spark):
    assert normalize_header(spark.createDataFrame([("1", "2")], '`"a"` string, `b` string')).columns == ["a", "b"]


def test_gaps_in_positions_fail_instead_of_numbering_wrong(spark, tmp_path):
    path = put(tmp_path, "a.csv", "".join(f"{n}\n" for n in range(50)))
    scan = source.with_position(source.scan_lines(spark, [path]))
    assert source.number_scan(spark, scan, [path]).agg(F.max("line_no")).first()[0] == 50
    moved = scan.withColumn("_id", F.col("_id") * 2)
    with pytest.raises(Exception, match="file splits changed"):
        source.number_scan(spark, moved, [path]).agg(F.max("line_no")).first()


def test_merge_files(spark, tmp_path):
    paths = [
        put(tmp_path, "1.csv", "n,a\nx,1\nn,a\n"),
        put(tmp_path, "2.csv", "y,2\nx,1\n"),
        put(tmp_path, "3.csv", "n,a\r\ny,2\r\nz,3"),
    ]
    lines = read_lines(spark, paths)
    merged = merge.merge_dedup(lines, ordered=True).collect()
    assert [(row["line"], row["is_header"]) for row in merged] == [
        ("n,a", True), ("x,1", False), ("n,a", False), ("y,2", False), ("z,3", False)]
    mixed = merge.merge_dedup_mixed(lines).orderBy("ord").collect()
    assert [row["line"] for row in mixed] == ["n,a", "x,1", "n,a", "y,2", "z,3"]
    ordered = merge.merge_dedup_sorted(lines, numbered=True).orderBy("place").collect()
    assert [(row["place"], row["line"]) for row in ordered] == [(1, "n,a"), (2, "n,a"), (3, "x,1"), (4, "y,2"), (5, "z,3")]
    assert tuple(profiles.count_lines(read_lines(spark, paths[0])).first()) == (3, 2)


def test_overlapping_entries_are_refused(spark, tmp_path):
    path = put(tmp_path, "a.csv", "h\n1\n")
    with pytest.raises(ValueError, match="listed both"):
        read_lines(spark, [path, str(tmp_path)])


ODD_LINES = ["x", "", "y", "a\0b", "back\\slash", "trailing  ", "\ttab", '"quoted"', "é"]


def test_written_lines_are_the_lines(spark, tmp_path, lines_of):
    lines = lines_of({"f": ODD_LINES}).coalesce(1).sortWithinPartitions("ord")
    write_lines(lines, str(tmp_path / "out"), header="h")
    assert part_texts(tmp_path / "out") == ["\n".join(["h", *ODD_LINES]) + "\n"]
    write_lines(lines.unionByName(lines_of({"g": ["", "1"]})).repartition(5), str(tmp_path / "by"), "h", partition_by="file", order_by="line_no")
    assert part_texts(tmp_path / "by" / "file=f") == ["\n".join(["h", *ODD_LINES]) + "\n"]
    assert part_texts(tmp_path / "by" / "file=g") == ["h\n\n1\n"]
    write_lines(lines, str(tmp_path / "pieces"), "h", partition_by="file", order_by="line_no", piece_lines=5)
    texts = [part_texts(tmp_path / "pieces" / "file=f" / f"piece={n}") for n in (0, 1)]
    assert texts == [["\n".join(["h", *ODD_LINES[:5]]) + "\n"], ["\n".join(["h", *ODD_LINES[5:]]) + "\n"]]


def test_folder_header_is_the_first_files(spark, tmp_path):
    put(tmp_path, "a.csv", "x,y\n1,2\n")
    put(tmp_path, "b.csv", "p,q\n" + "3,4\n" * 500)
    assert read_records(spark, str(tmp_path)).columns[:2] == ["x", "y"]


def test_names_that_come_twice(spark, tmp_path):
    rows = read_records(spark, put(tmp_path, "twice.csv", "a,a,A\n1,2,3\n"))
    assert rows.columns[:3] == ["a", "a_2", "A_3"] and tuples(rows, "a", "a_2", "A_3") == [("1", "2", "3")]


def test_quoted_breaks_are_marked_or_read_whole(spark, tmp_path):
    path = put(tmp_path, "breaks.csv", 'a,b,c\n1,2,"c\nd"\n4,5,6\n')
    rows = read_records(spark, path)
    assert [row["_corrupt"] is None for row in rows.orderBy("_ord").collect()] == [False, False, True]
    whole = read_records(spark, path, multi_line=True)
    assert sorted(tuples(whole, "a", "c")) == [("1", "c\nd"), ("4", "6")]
    with pytest.raises(Exception, match="multi_line"):
        read_records(spark, path, strict=True).collect()


def test_chunks_of_several_files_stay_apart(spark, tmp_path):
    put(tmp_path, "a.csv", "k\n1\n2\n3\n")
    put(tmp_path, "b.csv", "k\n4\n5\n6\n")
    rows = read_records(spark, str(tmp_path / "*.csv"))
    write_chunks(slices.split_chunks(rows, 2), str(tmp_path / "out"), "part")
    found = {str(folder.relative_to(tmp_path / "out")): part_texts(folder) for folder in (tmp_path / "out").glob("file=*/chunk=*")}
    assert found == {
        "file=0/chunk=part_001": ["k\n1\n2\n"], "file=0/chunk=part_002": ["k\n3\n"],
        "file=1/chunk=part_001": ["k\n4\n5\n"], "file=1/chunk=part_002": ["k\n6\n"]}


@pytest.mark.parametrize("dropped", [(), (1, 2, 3, 4, 5), range(21, 41)])
def test_a_large_chunk_is_written_by_many_tasks_under_one_header(spark, records_of, tmp_path, dropped):
    rows = records_of(["k", "text"], [(str(n), f'"{n},') for n in range(1, 48)]).repartition(5)
    chunked = slices.split_chunks(rows, 20).filter(~F.col("_row_no").isin(list(dropped)))
    write_chunks(chunked, str(tmp_path / "whole"), "part")
    write_chunks(chunked, str(tmp_path / "cut"), "part", piece_records=4)

    def joined(folder):
        pieces = sorted(folder.glob("piece=*"), key=lambda one: int(one.name.split("=")[1])) or [folder]
        texts = [part_texts(piece) for piece in pieces]
        assert all(len(one) == 1 for one in texts)
        return len(texts), "".join(one[0] for one in texts)

    for chunk in (1, 2, 3):
        kept = [n for n in range(chunk * 20 - 19, min(chunk * 20, 47) + 1) if n not in dropped]
        name = f"chunk=part_{chunk:03d}"
        if not kept:
            assert not (tmp_path / "whole" / name).exists() and not (tmp_path / "cut" / name).exists()
            continue
        want = "k,text\n" + "".join(f'{n},"""{n},"\n' for n in kept)
        assert joined(tmp_path / "whole" / name) == (1, want)
        assert joined(tmp_path / "cut" / name) == (len({(n - 1) // 4 for n in kept}), want)

"""What is kept of files read before: profiles, sketches and merges that grow."""

import os
from urllib.parse import unquote

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tabwright.operators import headers, merge, profiles, slices
from tabwright.sources import kept, read_lines


def put(folder, name, content, moment=None):
    path = folder / name
    path.write_text(content)
    if moment:
        os.utime(path, (moment, moment))
    return str(path)


def by_name(df, *columns):
    return {unquote(row["file"]).rsplit("/", 1)[-1]: tuple(row[name] for name in columns) for row in df.collect()}


@pytest.fixture
def read_files(monkeypatch):
    """Every list of files that is read as lines, in order."""
    seen = []
    for module in (kept, merge):
        monkeypatch.setattr(module, "read_lines", lambda spark, paths, charset=None: (
            seen.append([path.rsplit("/", 1)[-1] for path in paths]), read_lines(spark, paths, charset))[1])
    return seen


def test_profile_reads_new_and_changed_files_only(spark, tmp_path, read_files):
    data, state = tmp_path / "in", str(tmp_path / "state")
    data.mkdir()
    put(data, "a b%20[1].csv", "h,x\n1,2\nh,x\n1,2\n", 1_700_000_000)
    put(data, "e.csv", "")
    first = kept.kept_profile(spark, str(data), state)
    assert by_name(first, "lines", "header") == {"a b%20[1].csv": (4, "h,x"), "e.csv": (0, None)}
    assert len(read_files) == 1
    assert kept.kept_profile(spark, str(data), state).count() == 2 and len(read_files) == 1
    put(data, "c.csv", "3,4\n5,6\n", 1_700_000_000)
    assert by_name(kept.kept_profile(spark, str(data), state), "lines")["c.csv"] == (2,)
    assert read_files[1:] == [["c.csv"]]
    put(data, "c.csv", "k,l\n5,6\n7,8\n", 1_700_000_100)
    assert by_name(kept.kept_profile(spark, str(data), state), "lines", "header")["c.csv"] == (3, "k,l")
    assert read_files[2:] == [["c.csv"]]
    # Same length, other time; another charset is another row.
    put(data, "c.csv", "k,m\n5,6\n7,8\n", 1_700_000_200)
    assert by_name(kept.kept_profile(spark, str(data), state), "header")["c.csv"] == ("k,m",)
    kept.kept_profile(spark, str(data), state, charset="ISO-8859-1")
    assert len(read_files) == 5 and len(read_files[4]) == 2


def test_header_jobs_need_no_scan_or_one_less(spark, tmp_path):
    paths = [put(tmp_path, "a.csv", "h,x\n1,2\nh,x\n1,2\n"), put(tmp_path, "b.csv", "3,4\n5,6\n")]
    profile = kept.kept_profile(spark, paths, str(tmp_path / "state"))
    top, lines = kept.top_lines(profile), read_lines(spark, paths)
    for job in (headers.check_header, headers.detect_missing_header):
        assert sorted(job(top).collect()) == sorted(job(lines).collect())
        assert "Relation [value" not in job(top)._jdf.queryExecution().optimizedPlan().toString()
    known = slices.drop_repeated_header(lines, profile)
    assert sorted(tuples(known, "ord", "line")) == sorted(tuples(slices.drop_repeated_header(lines), "ord", "line"))
    assert by_name(profiles.has_repeated_header(lines, profile), "repeats") == {"a.csv": (1,)}
    assert tuples(top.orderBy("ord"), "line_no", "file_lines", "top_file") == [(1, 4, True), (1, 2, False)]


def test_sketches_unite_without_reading(spark, tmp_path):
    sizes = {"a.csv": range(0, 30_000), "b.csv": range(20_000, 50_000), "one.csv": range(0)}
    paths = [put(tmp_path, name, "h\n" + "".join(f"{n}\n" for n in numbers)) for name, numbers in sizes.items()]
    profile = kept.kept_profile(spark, paths, str(tmp_path / "state"))
    for some, exact in ((["a.csv"], 30_000), (["b.csv"], 30_000), (list(sizes), 50_000), (["one.csv"], 0)):
        chosen = profile.filter(F.substring_index("file", "/", -1).isin(some))
        found = profiles.count_unique_kept(chosen)
        assert abs(found.first()[0] - exact) <= 0.033 * exact
    assert profiles.count_unique_kept(profile.limit(0)).first()[0] in (0, None)
    assert profiles.count_unique_kept(profile, ["file"]).count() == 3


def expect_same(spark, grown, paths):
    columns = ("ord", "line", "is_header")
    assert sorted(tuples(grown, *columns)) == sorted(tuples(merge.merge_dedup(read_lines(spark, paths)), *columns))


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_merge_grows_by_the_files_that_came(spark, tmp_path, read_files, monkeypatch, limit):
    state, hot = str(tmp_path / "state"), "hot\n" * 500
    a = put(tmp_path, "a.csv", "h\n1\n2\nh\n")
    paths = [put(tmp_path, "e.csv", ""), a]
    expect_same(spark, merge.merge_dedup_grown(spark, paths, state), paths)
    monkeypatch.setattr(merge.scale, "BROADCAST_BYTES", limit)
    paths += [put(tmp_path, "b.csv", "h\n2\n3\n" + hot + "h\n"), a]
    expect_same(spark, merge.merge_dedup_grown(spark, paths, state), paths)
    paths.append(put(tmp_path, "c.csv", "other\nhot\n4\n3\n"))
    expect_same(spark, merge.merge_dedup_grown(spark, paths, state), paths)
    assert read_files == [["e.csv", "a.csv"], ["b.csv", "a.csv"], ["c.csv"]]
    expect_same(spark, merge.merge_dedup_grown(spark, paths, state), paths)
    assert len(read_files) == 3


def test_merge_starts_anew_where_the_head_of_the_list_changed(spark, tmp_path, read_files):
    state = str(tmp_path / "state")
    paths = [put(tmp_path, "a.csv", "h\n1\n2\n", 1_700_000_000), put(tmp_path, "b.csv", "h\n2\n3\n", 1_700_000_000)]
    merge.merge_dedup_grown(spark, paths[:1], state)
    merge.merge_dedup_grown(spark, paths, state)
    put(tmp_path, "b.csv", "h\n2\n4\n", 1_700_000_100)
    expect_same(spark, merge.merge_dedup_grown(spark, paths, state), paths)
    assert read_files[2:] == [["b.csv"]]
    turned = paths[::-1]
    expect_same(spark, merge.merge_dedup_grown(spark, turned, state), turned)
    assert read_files[3:] == [["b.csv", "a.csv"]]
    # A step that was written and not named in the table of files counts for nothing.
    spark.createDataFrame([("lost", False, 0, 0)], merge.GROWN_LINES).write.parquet(f"{state}/lines/step=lost")
    expect_same(spark, merge.merge_dedup_grown(spark, turned, state), turned)
    expect_same(spark, merge.merge_dedup_grown(spark, paths, state), paths)
    # A shorter list is the steps that cover it.
    expect_same(spark, merge.merge_dedup_grown(spark, paths[:1], state), paths[:1])

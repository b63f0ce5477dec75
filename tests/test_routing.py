"""Clean rows, rejects and summary out of one pass."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import dates, quality
from tabwright.plans.models import MOROSOS
from tabwright.sources import read_records, write_records, write_rejects


@pytest.fixture
def exports(tmp_path):
    """Two files of debtor records, some ragged, some with broken numbers or bytes."""
    names, paths = list(MOROSOS.columns), []
    for file in range(2):
        rows = [",".join(names).encode()]
        for place in range(60):
            cells = [str(place + 1)] * len(names)
            if place % 7 == 3:
                cells[names.index("IdCliente")] = "x"
            if place % 11 == 5:
                cells.append("more")
            if place % 13 == 6:
                cells[3] = "\xf1"
            rows.append(",".join(cells).encode("latin-1"))
        path = tmp_path / f"{file}.csv"
        path.write_bytes(b"\n".join(rows) + b"\n")
        paths.append(str(path))
    return paths


def counted(df, seen):
    """The table behind a step that counts the rows passing it."""
    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


JOBS = {
    "strict": lambda df: quality.sanitize_for_import(df, MOROSOS, rule="strict38"),
    "lenient": lambda df: quality.sanitize_for_import(df, MOROSOS),
    "audit": lambda df: quality.audit_numeric(df, MOROSOS, cap=5),
    "schema": lambda df: quality.audit_schema(df, MOROSOS),
    "model": lambda df: quality.validate_model(df, MOROSOS, max_show=9),
    "ragged": quality.drop_ragged,
    "keys": lambda df: quality.extract_keys(df, MOROSOS, limit=7),
    "resume": quality.extract_resume_key,
    "digits": lambda df: quality.check_numeric_keys(df, MOROSOS),
    "dates": lambda df: dates.convert_date(df, "CreateDate"),
}


def rows_of(df):
    return sorted(str(tuple(row)) for row in df.collect())


@pytest.mark.parametrize("job", JOBS)
def test_one_pass_gives_what_three_give(spark, exports, job):
    seen = spark.sparkContext.accumulator(0)
    records = counted(read_records(spark, exports), seen)
    apart = JOBS[job](records)
    once = apart.routed_once()
    assert seen.value == 120
    for name in ("clean", "rejects", "summary"):
        assert getattr(once, name).columns == getattr(apart, name).columns
        if job not in ("audit", "model", "keys"):
            assert rows_of(getattr(once, name)) == rows_of(getattr(apart, name))
        else:
            # Capped reports have the first rows in input order.
            assert getattr(once, name).count() == getattr(apart, name).count()
    assert rows_of(once.summary) == rows_of(apart.summary)


def test_writing_all_three_scans_the_input_once(spark, exports, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    once = JOBS["strict"](counted(read_records(spark, exports), seen)).routed_once()
    write_records(once.clean, str(tmp_path / "clean"))
    write_rejects(once.rejects, str(tmp_path / "rejects"), with_file=True)
    once.summary.collect()
    assert seen.value == 120
    # Each outcome is a partition: clean rows do not read the rejects.
    plan = once.clean._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_tw_ok" in plan and "MapInArrow" not in plan


def test_names_a_file_format_may_refuse(spark, records_of):
    odd = records_of(["a b", "c.d", "x,y;z", "d=(1)"], [("1", "2", "3", "4")])
    with_width = odd.withColumns({"_n_fields": F.lit(4), "_corrupt": F.lit(None).cast("string")})
    assert quality.drop_ragged(with_width).routed_once().clean.select("`x,y;z`", "`d=(1)`").first() == ("3", "4")


def test_empty_input(spark, records_of):
    none = records_of(list(MOROSOS.columns), [])
    once = JOBS["strict"](none).routed_once()
    assert once.clean.collect() == [] and once.rejects.collect() == []
    assert once.summary.first()["processed"] == 0


def test_keys_name_their_file(spark, exports):
    found = quality.extract_keys(read_records(spark, exports), MOROSOS)
    for part in (found.clean, found.rejects):
        rows = part.select("file", "ord", "record").collect()
        assert len({row["ord"] for row in rows}) == len(rows)
        assert all((row["ord"] >> 40 == 0) == row["file"].endswith("0.csv") and (row["ord"] & (1 << 40) - 1) == row["record"] + 1 for row in rows)

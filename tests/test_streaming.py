from tabwright.operators import dates, quality
from tabwright.plans.models import TableModel
from tabwright.plans.results import JobResult
from tabwright.sources import read_records
from tabwright.streaming.arriving import start_job, stream_records

MODEL = TableModel("t", ("K", "when"), ("K",), ("K",))


def test_files_are_routed_once_as_they_arrive(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    paths = [str(tmp_path / name) for name in ("clean", "rejects", "state")]

    def job(batch):
        numbers = quality.sanitize_for_import(batch, MODEL)
        days = dates.convert_date(numbers.clean, "when")
        return JobResult(days.clean, numbers.rejects, numbers.summary)

    def run():
        records = stream_records(spark, str(inbox), ["K", "when"], max_files=1)
        start_job(records, job, *paths).awaitTermination(120)

    (inbox / "a.csv").write_text("K,when\n1,25/12/2024 10:00\nx,25/12/2024 10:00\n")
    run()
    (inbox / "b.csv").write_text("K,when\n2,2024-01-01T00:00\n3,bad\n4\n")
    run()
    run()
    clean = spark.read.option("header", True).csv(paths[0])
    assert sorted((row["K"], row["when"]) for row in clean.collect()) == [("1", "2024-12-25T10:00:00"), ("2", "2024-01-01T00:00:00")]
    rejects = spark.read.option("header", True).csv(paths[1])
    assert sorted(row["error_type"] for row in rejects.collect()) == ["COLUMN_COUNT", "INVALID_NUMERIC"]
    assert read_records(spark, str(inbox)).count() == 5

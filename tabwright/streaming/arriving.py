"""Row-wise jobs over files as they arrive.

Only jobs that look at one record at a time run here (filter, date conversion,
sanitising, validation), so no state is kept.  Line numbers need finished
files, so the ``line`` of a reject is NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.functions.cells import text
from tabwright.functions.csvtext import field_count
from tabwright.plans.results import CORRUPT, FIELDS, JobResult
from tabwright.sources.records import csv_options, record_schema
from tabwright.sources.sinks import write_records


def stream_records(
    spark: SparkSession, folder: str, names: list[str], header: bool = True, max_files: int | None = None
) -> DataFrame:
    """Records of the files put into a folder; ragged rows are kept and marked."""
    reader = spark.readStream.schema(record_schema(names)).options(**csv_options(strict=False)).option("header", header)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.csv(folder)
    width = F.when(F.col(CORRUPT).isNull(), F.lit(len(names))).otherwise(field_count(F.col(CORRUPT)))
    return raw.select(
        *[text(f"`{name}`").alias(name) for name in names],
        F.col("_metadata.file_path").alias("_file"), width.alias(FIELDS), CORRUPT,
    )


def start_job(
    records: DataFrame,
    job: Callable[[DataFrame], JobResult],
    clean_path: str,
    rejects_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Run a routing job over every batch of arrived files, then stop.

    A batch owns one folder of each output and overwrites it, so a batch that is
    replayed after a failure leaves no duplicates.
    """
    def route(batch: DataFrame, number: int) -> None:
        result = job(batch)
        write_records(result.clean, f"{clean_path}/batch={number}", mode="overwrite")
        write_records(result.rejects, f"{rejects_path}/batch={number}", mode="overwrite")

    return (
        records.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

"""Writers.  Every part file carries the header, so a part is a readable file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.csvtext import render_header, render_line
from tabwright.plans.results import CHUNK, CHUNK_SIZE, ROW_NO, data_columns
from tabwright.plans.scale import POSITION_BITS

# Lines of one output folder that share a file, so a folder of any size is written by many tasks.
PIECE_LINES = 10_000_000


def normalize_header(df: DataFrame) -> DataFrame:
    """Take enclosing quotes off the column names."""
    return df.toDF(*[name.strip('"') for name in df.columns])


def write_lines(
    lines: DataFrame, path: str, header: str, partition_by: str | list[str] = (), mode: str = "errorifexists",
    order_by: str = "ord", piece_lines: int = PIECE_LINES,
) -> None:
    """Write the ``line`` column, every byte of it, under a header line.

    Without ``partition_by`` each task writes its rows as they stand, in one file.
    With it there is one folder per value, and in it one file per ``piece_lines``
    lines in the order of ``order_by`` (in folders ``piece=0``, ``piece=1``, ...).
    """
    folders = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    headed = F.concat_ws("\n", F.lit(header), "line")
    if not folders:
        # A task's first row has position 0 in it.
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_BITS))
        placed = lines.select("line", place.alias("_place"))
        kept = placed.select(F.when(F.col("_place") == 0, headed).otherwise(F.col("line")).alias("value"))
    else:
        inside = Window.partitionBy(*folders, "piece").orderBy(order_by)
        pieces = lines.withColumn("piece", F.expr(f"cast(`{order_by}` - 1 as bigint) div {piece_lines}"))
        kept = pieces.withColumn("_place", F.row_number().over(inside)).select(
            F.when(F.col("_place") == 1, headed).otherwise(F.col("line")).alias("value"), *folders, "piece")
        folders = [*folders, "piece"]
    kept.write.mode(mode).option("lineSep", "\n").partitionBy(*folders).text(path)


def write_records(
    df: DataFrame,
    path: str,
    quote: str = "necessary",
    mode: str = "errorifexists",
) -> None:
    """Write the data columns as RFC 4180 text.

    ``quote`` is ``necessary`` or ``non_numeric`` (every cell that is not a
    number).  Provenance columns (``_...``) stay out.
    """
    names = data_columns(df)
    write_lines(df.select(render_line(names, quote).alias("line")), path, render_header(names, quote), mode=mode)


def write_rejects(rejects: DataFrame, path: str, mode: str = "errorifexists", with_file: bool = False) -> None:
    """Reject log with the fixed five-column layout; ``with_file`` puts the file of each line first."""
    log = rejects.select(
        *([F.col("file").alias("File")] if with_file else []),
        F.col("line").alias("Line"),
        F.col("error_type").alias("ErrorType"),
        F.col("details").alias("Details"),
        F.col("table_key").alias("DynamoDbKey"),
        F.col("resume_key").alias("SqlCompositeKey"),
    )
    write_records(log, path, mode=mode)


def write_chunks(
    chunked: DataFrame, path: str, prefix: str, row_no: str = ROW_NO, mode: str = "errorifexists",
    piece_records: int = PIECE_LINES,
) -> None:
    """Records of each chunk of ``split_chunks`` under one header, in the folder ``chunk=prefix_001``.

    A chunk of up to ``piece_records`` records is one file.  A larger one is cut by
    row number into files in the folders ``piece=0``, ``piece=1``, ..., each written
    by its own task; read one after the other they are the chunk, and only the first
    has the header.  Records of several files (``_ord`` tells them apart) get a
    folder ``file=0``, ``file=1``, ... around their chunks.
    """
    names = [name for name in data_columns(chunked) if name != row_no]
    label = F.concat(F.lit(f"{prefix}_"), F.format_string("%03d", F.col(CHUNK)))
    file = [F.shiftright("_ord", 40).alias("file")] if "_ord" in chunked.columns else []
    folders = [*(["file"] if file else []), "chunk"]
    body = chunked.select(*file, label.alias("chunk"), F.col(row_no).alias("_no"), F.lit(1).alias("_rank"), render_line(names).alias("line"))
    # The header is a row of its own, before the first record that a chunk has.
    tops = body.groupBy(*folders).agg(F.min("_no").alias("_no")).withColumns(
        {"_rank": F.lit(0), "line": F.lit(render_header(names))})
    lines = body.unionByName(tops)
    if not 0 < chunked.schema[CHUNK].metadata.get(CHUNK_SIZE, 0) <= piece_records:
        lines = lines.withColumn("piece", F.expr(f"(_no - 1) div {piece_records}"))
        folders.append("piece")
    kept = lines.repartition(*folders).sortWithinPartitions(*folders, "_no", "_rank")
    kept.select(F.col("line").alias("value"), *folders).write.mode(mode).option("lineSep", "\n").partitionBy(*folders).text(path)

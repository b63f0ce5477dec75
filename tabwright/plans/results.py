"""What a routing job returns, and the layout of a table of records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.plans.scale import computed_once, new_folder

ROW_NO = "_row_no"
FIELDS = "_n_fields"
CORRUPT = "_corrupt"
CHUNK = "_chunk_id"
# Set on the chunk column by split_chunks.
CHUNK_SIZE = "chunk_size"
CONVERTED = "_converted"
PROVENANCE = frozenset({ROW_NO, "_file", "_ord", FIELDS, CORRUPT, CHUNK, CONVERTED})


OK = "_tw_ok"


@dataclass(frozen=True)
class Routing:
    """How a job tags its rows, and what it makes of tagged rows.

    ``tags`` has the boolean ``OK`` and whatever else the three plans read of a tagged
    row; ``clean`` gets the rows that are OK, ``rejects`` the others, ``summary`` all.
    """

    rows: DataFrame
    tags: dict[str, Column]
    clean: Callable[[DataFrame], DataFrame]
    rejects: Callable[[DataFrame], DataFrame]
    summary: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class JobResult:
    """Three plans over the same input; nothing runs until one is written.

    Each plan reads the input for itself.  Who wants more than one of them takes
    ``routed_once``, which reads it once.
    """

    clean: DataFrame
    rejects: DataFrame
    summary: DataFrame
    routing: Routing | None = field(default=None, compare=False, repr=False)

    def routed_once(self, folder: str | None = None) -> JobResult:
        """The same result out of one pass over the input.

        Rows are tagged once and written once, as Parquet in ``folder`` (by default a
        new one in the shared folder), one partition of the table for each outcome.
        Clean rows and rejects then read their own partition, and the summary the tags
        alone.  Counts come from what was committed, not from accumulators, so tasks
        that ran twice after the loss of an executor cannot count twice.
        """
        routing = self.routing
        if routing is None:
            raise ValueError("this job does not route rows")
        spark, folder = routing.rows.sparkSession, folder or new_folder(routing.rows.sparkSession)
        tagged = computed_once(routing.rows, routing.tags)
        # Stored under names of our own: a file format may refuse those of the table.
        inner = {name: name if name == OK else f"c{place}" for place, name in enumerate(tagged.columns)}
        stored = tagged.toDF(*inner.values())
        stored.write.partitionBy(OK).parquet(folder)
        saved = spark.read.schema(stored.schema).parquet(folder)
        named = saved.select(*[F.col(own).alias(name) for name, own in inner.items()])
        columns = [f"`{name.replace('`', '``')}`" for name in self.clean.columns]
        return JobResult(
            routing.clean(named.filter(F.col(OK))).select(*columns), routing.rejects(named.filter(~F.col(OK))), routing.summary(named),
        )


def data_columns(df: DataFrame) -> list[str]:
    """Columns of the table itself, without what readers and jobs add."""
    return [name for name in df.columns if name not in PROVENANCE]


def quoted(names: list[str]) -> list[Column]:
    """Columns by exact name, dots and blanks included."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"column(s) {missing} not found; the table has {df.columns}")


def place_of(df: DataFrame, row_no: str = ROW_NO) -> Column:
    """Input order over all files where the reader gave it, else the row number."""
    return F.col("_ord") if "_ord" in df.columns else F.col(row_no)


def file_of(df: DataFrame) -> Column:
    return F.col("_file") if "_file" in df.columns else F.lit(None).cast("string")


def width_of(df: DataFrame, row_no: str = ROW_NO) -> int:
    return len([name for name in data_columns(df) if name != row_no])


def is_ragged(df: DataFrame, width: int) -> Column:
    return F.col(FIELDS) != width if FIELDS in df.columns else F.lit(False)


def is_undecodable(df: DataFrame) -> Column:
    """The record has bytes that are no UTF-8: its cells are not those of the file."""
    if CORRUPT not in df.columns:
        return F.lit(False)
    return F.coalesce(~F.is_valid_utf8(F.col(CORRUPT)), F.lit(False))


def is_unreadable(df: DataFrame, width: int) -> Column:
    """The width fits but the text is no record."""
    return ~is_ragged(df, width) & F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)


def corrupt_text(df: DataFrame) -> Column:
    """The text of a broken record; one that cannot be decoded as its bytes in hex."""
    if CORRUPT not in df.columns:
        return F.lit(None).cast("string")
    return F.when(is_undecodable(df), F.hex(F.col(CORRUPT).cast("binary"))).otherwise(F.col(CORRUPT))


def structure_error(df: DataFrame, width: int) -> Column:
    """Why a record's cells cannot be trusted; NULL for a sound one."""
    return (
        F.when(is_undecodable(df), "ENCODING_ERROR").when(is_ragged(df, width), "COLUMN_COUNT")
        .when(is_unreadable(df, width), "PARSE_ERROR")
    )


def sound_rows(df: DataFrame, strict: bool = False, row_no: str = ROW_NO) -> DataFrame:
    """Rows that fit their header and could be read; with ``strict`` any other row fails the job."""
    if FIELDS not in df.columns and CORRUPT not in df.columns:
        return df
    width = width_of(df, row_no)
    unsound = is_ragged(df, width) | is_unreadable(df, width)
    if not strict:
        return df.filter(~unsound)
    return df.filter(F.when(unsound, F.raise_error(F.lit("a record does not fit its header")).cast("boolean")).otherwise(F.lit(True)))


def unsound_rows(df: DataFrame, row_no: str = ROW_NO) -> DataFrame:
    """(file, line, ord, error_type, record) of the rows that ``sound_rows`` leaves out."""
    width = width_of(df, row_no)
    line = F.col(row_no) + 1 if row_no in df.columns else F.lit(None).cast("bigint")
    return df.filter(is_ragged(df, width) | is_unreadable(df, width)).select(
        file_of(df).alias("file"), line.alias("line"),
        (F.col("_ord") if "_ord" in df.columns else F.lit(None).cast("bigint")).alias("ord"),
        structure_error(df, width).alias("error_type"), corrupt_text(df).alias("record"),
    )

"""Records with line breaks in quotes, out of files that split.

A line is read with a two-state automaton: outside or inside a quoted cell.  A
quote opens a cell only at its beginning, two quotes inside are one, so each line
takes the state at its beginning to the state at its end.  A block does not know
how it begins; a first pass therefore sums it up for both cases (state at its end,
records that begin in it).  Composing these sums along the blocks of a file, a
window over that small table, gives every block its first state and the number of
records before it.  The second pass cuts each block into records in one run over
its lines.  Records that lie within a block, nearly all, are never moved; only
the pieces of records that cross a block's border meet by a shuffle, under the
number of their record.

Both runs over the lines are Arrow batches in scan order: a state carried from
line to line has no built-in expression.  Batches are looked at line by line only
where there is a quote.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.plans import scale
from tabwright.plans.scale import cut_lineage, in_arrow, measured_bytes
from tabwright.sources.lines import file_list, ordinal, scan_lines, without_cr

# A quoted cell that ends, behind the comma before it; and the rest of one that began earlier.
_CLOSED = re.compile(rb',"[^"]*+(?:""[^"]*+)*+"')
_REST = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')
_WHOLE, _PIECE = 0, 1


def _opens(text: bytes) -> bool:
    return b',"' in _CLOSED.sub(b",", text)


def ends_inside(line: bytes, inside: bool) -> bool:
    """The state at the end of a line that begins ``inside`` a quoted cell, or at a new record."""
    if not inside:
        return _opens(b"," + line)
    rest = _REST.match(line)
    return True if rest is None else _opens(line[rest.end() :])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, lines as bytes): the consecutive rows of one block in each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("_file").dictionary_encode(), batch.column("_block").to_numpy()
        codes = files.indices.to_numpy()
        turns = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for start, end in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
            yield files.dictionary[int(codes[start])].as_py(), int(blocks[start]), batch.column("_data").slice(start, end - start)


def _features(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lines with a quote, and which lines are not blank."""
    quotes = np.flatnonzero(pc.match_substring(lines, b'"').to_numpy(zero_copy_only=False))
    blank = pc.or_(pc.equal(pc.binary_length(lines), 0), pc.equal(lines, pa.scalar(b"\r", pa.binary())))
    return quotes, ~blank.to_numpy(zero_copy_only=False)


def block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: the state at its end and the records that begin in it, for each state at its beginning."""
    here, states, records = None, [False, True], [0, 0]

    def row() -> pa.RecordBatch:
        columns = [[here[0]], [here[1]], [states[0]], [states[1]], [records[0]], [records[1]]]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        names = ["_file", "_block", "_end_out", "_end_in", "_records_out", "_records_in"]
        return pa.RecordBatch.from_arrays([pa.array(*pair) for pair in zip(columns, kinds)], names)

    for file, block, lines in _runs(batches):
        if here != (file, block):
            if here is not None:
                yield row()
            here, states, records = (file, block), [False, True], [0, 0]
        quotes, filled = _features(lines)
        before = np.concatenate([[0], np.cumsum(filled)])
        for case in (0, 1):
            at = 0
            for place in quotes.tolist():
                # Up to this line, itself included, the state is the same.
                if not states[case]:
                    records[case] += int(before[place + 1] - before[at])
                states[case], at = ends_inside(lines[place].as_py(), states[case]), place + 1
            if not states[case]:
                records[case] += int(before[len(filled)] - before[at])
    if here is not None:
        yield row()


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_file, _block, _number, _kind, line): records within a block, and the pieces of those that cross its borders.

    ``_inside`` is the state at the beginning of a block and ``_before`` the records
    that began before it; a record's number counts from 1 in its file, and a piece
    has the number of its record.
    """
    here, inside, number, open_, crossing = None, False, 0, [], False

    def out(numbers, kinds, lines) -> pa.RecordBatch:
        files = pa.array([here[0]] * len(numbers), pa.string())
        return pa.RecordBatch.from_arrays([
            files, pa.array([here[1]] * len(numbers), pa.int64()), pa.array(numbers, pa.int64()),
            pa.array(kinds, pa.int32()), lines if isinstance(lines, pa.Array) else pa.array(lines, pa.binary()),
        ], ["_file", "_block", "_number", "_kind", "_data"])

    for batch in batches:
        begins, earlier, at = batch.column("_inside"), batch.column("_before"), 0
        for file, block, lines in _runs(iter([batch])):
            if here != (file, block):
                if open_:
                    yield out([number], [_PIECE], [b"\n".join(open_)])
                here, open_ = (file, block), []
                inside, number = begins[at].as_py(), earlier[at].as_py()
                if number is None:
                    raise ValueError("file splits changed between the two passes")
                # What a block begins with inside belongs to a record of an earlier block.
                crossing = inside
            at += len(lines)
            quotes, filled = _features(lines)
            # The state at the beginning of each line, from one line with quotes to the next.
            states, last = np.empty(len(lines) + 1, bool), 0
            for place in quotes.tolist():
                states[last : place + 1] = inside
                inside, last = ends_inside(lines[place].as_py(), inside), place + 1
            states[last:] = inside
            begins_here = ~states[:-1] & filled
            single = begins_here & ~states[1:]
            numbers = number + np.cumsum(begins_here)
            # Records of more than one line, and the end of one that is open from before.
            odd = np.flatnonzero(~single & (begins_here | states[:-1]))
            done_numbers, done_kinds, done = [], [], []
            for place in odd.tolist():
                open_.append(lines[place].as_py())
                if not states[place + 1]:
                    done_numbers.append(int(numbers[place]))
                    done_kinds.append(_PIECE if crossing else _WHOLE)
                    done.append(b"\n".join(open_))
                    open_, crossing = [], False
            number = int(numbers[-1]) if len(numbers) else number
            if single.any():
                yield out(numbers[single], np.full(int(single.sum()), _WHOLE, np.int32), lines.filter(pa.array(single)))
            if done:
                yield out(done_numbers, done_kinds, done)
    if open_:
        yield out([number], [_PIECE], [b"\n".join(open_)])


def block_states(scan: DataFrame) -> DataFrame:
    """(_file, _block, _inside, _before, _crosses): how each block of the files begins; counted here and now."""
    sums = in_arrow(
        scan, block_sums, "_file string, _block long, _end_out boolean, _end_in boolean, _records_out long, _records_in long")
    order = Window.partitionBy("_file").orderBy("_block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # A block either ends in one state whatever it began with, or passes its first state on (or turns it round).
    fixed, turned = F.col("_end_out") == F.col("_end_in"), F.col("_end_out") & ~F.col("_end_in")
    placed = sums.withColumn("_turns", F.coalesce(F.sum(turned.cast("int")).over(earlier), F.lit(0)))
    known = F.last(F.when(fixed, F.struct("_end_out", "_turns")), ignorenulls=True).over(earlier)
    placed = placed.withColumn("_known", known)
    odd = (F.col("_turns") - F.coalesce(F.col("_known._turns"), F.lit(0))) % 2 == 1
    placed = placed.withColumn("_inside", F.coalesce(F.col("_known._end_out"), F.lit(False)) != odd)
    began = F.when(F.col("_inside"), F.col("_records_in")).otherwise(F.col("_records_out"))
    ends = F.when(F.col("_inside"), F.col("_end_in")).otherwise(F.col("_end_out"))
    return cut_lineage(placed.select(
        "_file", "_block", "_inside", F.coalesce(F.sum(began).over(earlier), F.lit(0)).alias("_before"),
        (F.col("_inside") | ends).alias("_crosses"),
    ))


def scan_quoted(spark: SparkSession, paths: list[str], charset: str | None = None) -> DataFrame:
    """(file, file_ord, line_no, ord, line): one row per record, its line breaks in quotes kept; ``line_no`` counts records.

    Blank lines between records are left out.  A quote that nothing closes makes the
    rest of its file one record, as it does for any reader of the format.
    """
    scan = scan_lines(spark, paths, charset, keep_cr=True).select("_file", "_block", F.col("line").cast("binary").alias("_data"))
    blocks = block_states(scan)
    if measured_bytes(blocks) <= scale.BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    # No line may be filtered before this join: fewer files would be split in another way.
    placed = scan.join(blocks, ["_file", "_block"], "left")

    def cut(lines: DataFrame) -> DataFrame:
        lines = lines.select("_file", "_block", "_data", "_inside", "_before")
        return in_arrow(lines, cut_records, "_file string, _block long, _number long, _kind int, _data binary")

    records = cut(placed).where(F.col("_kind") == _WHOLE).select("_file", "_number", "_data")
    if not blocks.where("_crosses").isEmpty():
        pieces = cut(placed.where("_crosses")).where(F.col("_kind") == _PIECE)
        parts = F.sort_array(F.collect_list(F.struct("_block", F.col("_data").cast("string").alias("text"))))
        joined = pieces.groupBy("_file", "_number").agg(F.array_join(F.transform(parts, lambda one: one["text"]), "\n").alias("_text"))
        records = records.unionByName(joined.select("_file", "_number", F.col("_text").cast("binary").alias("_data")))
    files = file_list(spark, paths).withColumnRenamed("file", "_file")
    if measured_bytes(files) <= scale.BROADCAST_BYTES:
        files = F.broadcast(files)
    return records.join(files, "_file").select(
        F.col("_file").alias("file"), "file_ord", F.col("_number").alias("line_no"),
        ordinal(F.col("file_ord"), F.col("_number")).alias("ord"), without_cr(F.col("_data").cast("string")).alias("line"),
    )

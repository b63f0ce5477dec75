"""Delimited text as expressions: rendering, counting and splitting cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.cells import is_float, text

QUOTE_STYLES = ("necessary", "non_numeric")
# Possessive, so that a cell of any length is matched in a loop, not by recursion.
QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def _quoted(cell: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))


def render_cell(cell: Column, quote: str = "necessary") -> Column:
    if quote == "necessary":
        return F.when(cell.rlike('[",\\r\\n]'), _quoted(cell)).otherwise(cell)
    if quote == "non_numeric":
        return F.when(is_float(cell), cell).otherwise(_quoted(cell))
    raise ValueError(f"unknown quote style {quote!r}; choose from {QUOTE_STYLES}")


def render_line(columns: list[str], quote: str = "necessary") -> Column:
    """One comma separated line out of the named columns."""
    cells = [render_cell(text(F.col(f"`{name}`")), quote) for name in columns]
    line = F.concat_ws(",", *cells)
    # A lone empty cell would render as a blank line, which readers skip.
    return F.when(line == "", F.lit('""')).otherwise(line) if len(columns) == 1 else line


def render_header(names: list[str], quote: str = "necessary") -> str:
    """Header text on the driver; header names are never numbers in practice."""
    def cell(name: str) -> str:
        if quote == "non_numeric" or any(mark in name for mark in '",\r\n'):
            return '"' + name.replace('"', '""') + '"'
        return name

    return ",".join(cell(name) for name in names)


def field_count(line: Column) -> Column:
    """Number of fields of a line; commas inside quotes do not count."""
    plain = ~F.contains(line, F.lit('"'))
    outside = F.when(plain, line).otherwise(F.regexp_replace(line, QUOTED, ""))
    bare = F.replace(outside, F.lit(","), F.lit(""))
    return F.octet_length(outside) - F.octet_length(bare) + 1


def split_cells(line: Column) -> Column:
    """Cells of a line with quotes decoded, in one run over its text."""
    # Every cell is matched with a comma in front of it, the first one too.
    pieces = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({QUOTED}[^,]*+|[^,]*+)"), F.lit(1))
    return F.transform(
        pieces,
        lambda piece: F.when(
            (F.length(piece) >= 2) & piece.startswith('"') & piece.endswith('"'),
            F.replace(F.substring(piece, F.lit(2), F.length(piece) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(piece),
    )

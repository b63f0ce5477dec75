"""Cell rules: small Column builders used inside the jobs.

Every rule is a plain built-in expression, so it stays inside whole-stage
code generation and never starts a Python worker.  ``\\z`` closes each pattern
because Java's ``$`` also matches in front of a final line break.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the Unicode White_Space property, in code point order ---
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

ASCII_WHITE_SPACE = "\t\n\u000b\u000c\r "

# --- fixed values: number grammars ---
FLOAT = r"[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))"
PLAIN_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?"
SCIENTIFIC = r"-?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
MAX_SIGNIFICANT_DIGITS = 38
FLOAT_PATTERN = rf"^{FLOAT}\z"
SCIENTIFIC_PATTERN = rf"^{SCIENTIFIC}\z"
DIGITS_PATTERN = r"^[0-9]+\z"
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
DATE_SHAPE_PATTERN = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?\z"

# One pattern per rule, plain digits tried first: a single match per cell keeps
# generated code small enough for the JIT.
_WS = "[" + "".join(f"\\u{ord(mark):04x}" for mark in WHITE_SPACE) + "]"
LENIENT_PATTERN = rf'^(?:[0-9]++|{_WS}*+"*+(?:{FLOAT})?"*{_WS}*)\z'
STRICT38_PATTERN = (
    rf"^(?:[1-9][0-9]{{0,{MAX_SIGNIFICANT_DIGITS - 1}}}"
    rf"|{_WS}*+(?=-?(?:[0-9]\.?){{1,{MAX_SIGNIFICANT_DIGITS}}}{_WS}*\z){PLAIN_NUMBER}{_WS}*)\z"
)


def text(value: Column | str) -> Column:
    """The cell as text, with a missing cell read as ''."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit(""))


def trim_ws(value: Column) -> Column:
    """Trim Unicode white space at both ends (Spark's ``trim`` is space-only)."""
    # The short trim set is several times faster and enough for ASCII cells.
    ascii_only = F.octet_length(value) == F.length(value)
    return F.when(ascii_only, F.btrim(value, F.lit(ASCII_WHITE_SPACE))).otherwise(
        F.btrim(value, F.lit(WHITE_SPACE))
    )


def rtrim_ws(value: Column) -> Column:
    return F.rtrim(value, F.lit(WHITE_SPACE))


def is_float(value: Column) -> Column:
    """A floating point literal: sign, exponent, inf and nan allowed."""
    return value.rlike(FLOAT_PATTERN)


def is_lenient_number(value: Column) -> Column:
    """Empty, or a float once white space and enclosing quotes are taken off."""
    return value.rlike(LENIENT_PATTERN)


def is_strict38_number(value: Column) -> Column:
    """Plain decimal: no plus sign, leading zeros or exponent; 38 digits at most."""
    return value.rlike(STRICT38_PATTERN)


def is_scientific_number(value: Column) -> Column:
    """Finite number, exponent allowed, nothing around it, no plus sign."""
    return value.rlike(SCIENTIFIC_PATTERN)


def is_digits(value: Column) -> Column:
    return trim_ws(value).rlike(DIGITS_PATTERN)


def is_int64(value: Column) -> Column:
    return value.rlike(INTEGER_PATTERN) & value.try_cast("bigint").isNotNull()


def is_int32(value: Column) -> Column:
    wide = value.try_cast("bigint")
    return value.rlike(INTEGER_PATTERN) & F.coalesce(wide.between(-(2**31), 2**31 - 1), F.lit(False))


def is_date_shaped(value: Column) -> Column:
    """``yyyy-MM-dd`` with optional ``HH:mm:ss``; digits and widths only."""
    return value.rlike(DATE_SHAPE_PATTERN)


NUMBER_RULES = {
    "lenient": is_lenient_number,
    "strict38": is_strict38_number,
    "scientific": is_scientific_number,
}


def number_rule(name: str):
    try:
        return NUMBER_RULES[name]
    except KeyError:
        raise ValueError(f"unknown number rule {name!r}; choose from {sorted(NUMBER_RULES)}") from None


def key_text(names: list[str], values: list[Column]) -> Column:
    """``{K=v,S=w}`` text of a composite key."""
    parts = [F.concat(F.lit(f"{name}="), value) for name, value in zip(names, values)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

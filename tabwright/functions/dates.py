"""Date grammars as expressions.

Text of a known shape is put in ISO order and cast to a zone-less timestamp, so
the session time zone never moves a value and an impossible date such as 31/02
becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted date shapes ---
ISO_T = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}(?::\d{1,2})?\z"
ISO_ANY = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2})?)?\z"
SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}(?::\d{1,2})?)\z"
MONTH_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: (\d{1,2}:\d{1,2}:\d{1,2}))?\z"
US_12_HOUR = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (?:0?[1-9]|1[0-2]):\d{1,2}:\d{1,2} [AaPp][Mm]\z"
US_CLOCK = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (.*) .M\z"
DAY_MONTH_YEAR = r"^(\d{2})/(\d{2})/(\d{4})\z"


def _cast(iso: Column) -> Column:
    return iso.try_cast("timestamp_ntz")


def parse_mixed(value: Column) -> Column:
    """ISO with ``T``, then day first, then month first; seconds optional."""
    day_first = _cast(F.regexp_replace(value, SLASHED, "$3-$2-$1 $4"))
    month_first = _cast(F.regexp_replace(value, SLASHED, "$3-$1-$2 $4"))
    return F.when(value.rlike(ISO_T), _cast(value)).when(
        value.rlike(SLASHED), F.coalesce(day_first, month_first)
    )


def parse_us12(value: Column) -> Column:
    """``MM/dd/yyyy hh:mm:ss AM/PM``; hour 0 and hours above 12 are refused."""
    # Hour 12 is hour 0 of its half day; only the hour follows a blank.
    clock = F.regexp_replace(F.replace(F.upper(value), F.lit(" 12:"), F.lit(" 0:")), US_CLOCK, "$3-$1-$2 $4")
    half_day = F.when(value.rlike("[Pp].\\z"), F.expr("INTERVAL 12 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    return F.when(value.rlike(US_12_HOUR), _cast(clock) + half_day)


def _without_counter(value: Column) -> Column:
    return F.when(F.contains(value, F.lit(",")), F.regexp_replace(value, r"^\d+,", "")).otherwise(value)


def _month_first(value: Column) -> Column:
    return F.when(value.rlike(MONTH_FIRST), _cast(F.regexp_replace(value, MONTH_FIRST, "$3-$1-$2 $4")))


def parse_mdy(value: Column) -> Column:
    """Month first on a 24-hour clock, time optional; a leading ``1,`` is taken off."""
    return _month_first(_without_counter(value))


def parse_iso(value: Column) -> Column:
    """ISO date, with a time after a space or a ``T`` if there is one."""
    return F.when(value.rlike(ISO_ANY), _cast(value))


def parse_any(value: Column) -> Column:
    """US 12-hour, month first, or ISO."""
    bare = _without_counter(value)
    return F.coalesce(parse_us12(bare), _month_first(bare), parse_iso(value))


PARSERS = {
    "mixed": parse_mixed,
    "us12": parse_us12,
    "mdy": parse_mdy,
    "iso": parse_iso,
    "any": parse_any,
}


def parser(name: str):
    try:
        return PARSERS[name]
    except KeyError:
        raise ValueError(f"unknown date grammar {name!r}; choose from {sorted(PARSERS)}") from None


def iso_text(moment: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a zone-less timestamp with whole seconds."""
    return F.translate(moment.cast("string"), " ", "T")


def us12_text(plain: Column) -> Column:
    """``MM/dd/yyyy hh:mm:ss AM/PM`` out of ``yyyy-MM-dd HH:mm:ss`` text."""
    hour = F.substring(plain, 12, 2).cast("int")
    clock = F.lpad((F.pmod(hour + 11, F.lit(12)) + 1).cast("string"), 2, "0")
    return F.concat(
        F.substring(plain, 6, 2), F.lit("/"), F.substring(plain, 9, 2), F.lit("/"), F.substring(plain, 1, 4),
        F.lit(" "), clock, F.substring(plain, 14, 6), F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )


def day_month_to_iso(value: Column) -> Column:
    """``dd/MM/yyyy`` cells that are real dates become ISO dates, others NULL."""
    day = F.when(
        (F.length(value) == 10) & value.rlike(DAY_MONTH_YEAR),
        F.regexp_replace(value, DAY_MONTH_YEAR, "$3-$2-$1").try_cast("date"),
    )
    return day.cast("string")

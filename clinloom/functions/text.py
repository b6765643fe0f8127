"""Text, number and date helpers: Column in, Column out, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns ----------------------------------------------------
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATETIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?Z?$"
# the same, but only days and times that exist (29 February is left to the cast)
CALENDAR_DAY = (
    r"[0-9]{4}-((0[13578]|1[02])-(0[1-9]|[12][0-9]|3[01])|(0[469]|11)-(0[1-9]|[12][0-9]|30)|02-(0[1-9]|[12][0-9]))"
)
CLOCK = r"([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
# ISO date-time with a T or one space, optional seconds, fraction and zone
EVENT_PATTERN = (
    rf"^{CALENDAR_DAY}([T ]([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)?)?$"
)
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN_WORDS = ("true", "t", "yes", "y", "1", "false", "f", "no", "n", "0")
# characters that a whitespace strip removes
WHITESPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cut(value: Column | str, width: int) -> Column:
    return F.left(col(value).cast("string"), F.lit(width))


def normalized(value: Column | str) -> Column:
    """Outer spaces off."""
    return F.trim(col(value).cast("string"))


def clipped(value: Column | str, width: int) -> Column:
    """Normalised text, blank as NULL, shown in ``width`` characters."""
    return cut(F.nullif(normalized(value), F.lit("")), width)


def code_key(value: Column | str) -> Column:
    """The form a source code is looked up by: the whole code, outer spaces off."""
    return F.trim(col(value).cast("string"))


def has_code(value: Column | str) -> Column:
    return code_key(value) != ""


def stripped(value: Column | str) -> Column:
    """All outer whitespace off, not only spaces."""
    return F.regexp_replace(col(value), f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(stripped(value), F.lit(""))


def safe_double(value: Column | str) -> Column:
    text = F.trim(col(value).cast("string"))
    number = F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double"))
    return F.when(F.abs(number) != float("inf"), number)


def _whole_number(text: Column, low: int, high: int, kind: str) -> Column:
    # only what fits 64 bits is cast: a failed try_cast costs an exception per row
    digits = F.regexp_extract(text, r"^[+-]?0*([0-9]{1,19})$", 1)
    most = F.when(text.startswith("-"), "9223372036854775808").otherwise("9223372036854775807")
    fits = (digits != "") & ((F.length(digits) < 19) | (digits <= most))
    number = F.when(fits, text.try_cast("long"))
    return F.when(number.between(low, high), number).cast(kind)


def safe_int(value: Column | str) -> Column:
    return _whole_number(F.trim(col(value).cast("string")), -(2**31), 2**31 - 1, "int")


def safe_id(value: Column | str) -> Column:
    """An identifier as a long; NULL for blank, for anything not an integer, and beyond 64 bits."""
    return _whole_number(blank_to_null(col(value).cast("string")), -(2**63), 2**63 - 1, "long")


def is_bad_id(value: Column | str) -> Column:
    """True where a value is given but is not an integer of 64 bits."""
    return blank_to_null(value).isNotNull() & safe_id(value).isNull()


def moment_of(text: Column) -> Column:
    """Stripped ISO date-time text as a UTC moment without zone; NULL where it is none.

    The pattern keeps bad values from the cast: each failed one costs an exception.
    """
    return F.when(
        text.rlike(rf"^{CALENDAR_DAY}T{CLOCK}(\.[0-9]+)?Z?$"), F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz")
    )


def day_of(text: Column) -> Column:
    """Stripped ISO date text as a date; NULL where it is none."""
    return F.when(text.rlike(rf"^{CALENDAR_DAY}$"), text.try_cast("date"))


def utc_datetime(value: Column | str) -> Column:
    return moment_of(blank_to_null(value))


def event_date(value: Column | str) -> Column:
    """The calendar day of ISO date or date-time text, as written (no zone shift)."""
    text = blank_to_null(value)
    return F.when(text.rlike(EVENT_PATTERN), F.substring(text, 1, 10).try_cast("date"))


def birth_date_from_parts(moment: Column, year: Column, month: Column, day: Column) -> Column:
    """Date of a birth moment, else of year, month and day with 1 for a missing part."""
    month, day = F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1))
    written = F.concat_ws(
        "-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")
    )
    return F.coalesce(moment.cast("date"), F.when(year.isNotNull(), written.try_cast("date")))


def time_text(moment: Column | str) -> Column:
    return F.substring(col(moment).cast("string"), 12, 8)


def iso_text(moment: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` with a 7-digit fraction where there is one."""
    text = col(moment).cast("string")
    fraction = F.substring(text, 21, 6)
    return F.concat(
        F.substring(text, 1, 10),
        F.lit("T"),
        F.substring(text, 12, 8),
        F.when(fraction == "", "").otherwise(F.concat(F.lit("."), F.rpad(fraction, 7, "0"))),
    )


def plain_text(moment: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss.fffffff``."""
    text = col(moment).cast("string")
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 7, "0"))


def day_text(day: Column | str) -> Column:
    return col(day).cast("string")


def row_id(table: str, *parts: Column | str) -> Column:
    """``synthea:<table>:<part>:<part>``, NULL if a part is."""
    pieces: list[Column] = [F.lit(f"synthea:{table}")]
    for part in parts:
        pieces += [F.lit(":"), col(part)]
    return F.concat(*pieces)


def days_supply(start: Column, stop: Column) -> Column:
    """Days between the filled dates, at least 1; NULL if both are missing."""
    first, last = F.coalesce(start, stop), F.coalesce(stop, start)
    return F.when(first.isNotNull(), F.greatest(F.datediff(last.cast("date"), first.cast("date")), F.lit(1)))


def refills(dispenses: Column | str) -> Column:
    count = safe_int(dispenses)
    return F.when(count.isNotNull(), F.greatest(count, F.lit(1)) - 1)


def patient_share(total: Column, payer: Column) -> Column:
    return total - F.coalesce(payer, F.lit(0.0))


def null_if_unmatched(concept_id: Column) -> Column:
    return F.nullif(concept_id, F.lit(0))


def plain_decimal(value: Column) -> Column:
    """Decimal as text without exponent and trailing zeros."""
    text = value.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def completeness(filled: Column, rows: Column) -> Column:
    return F.when(rows == 0, F.lit(0.0)).otherwise(F.bround(filled / rows * 100, 2))

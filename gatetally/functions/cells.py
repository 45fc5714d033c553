"""Column expressions that clean one text cell.

Everything here is a built-in expression, so it stays inside generated code.
Bad text gives null instead of an error, whether or not ANSI mode is on.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"
# Fixed value: the characters a Python ``str.strip`` of plain ASCII removes.
ASCII_SPACE = " \t\n\r\x0b\x0c"
# Fixed value: decimal text that a float parser takes, special names included.
FLOAT_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"


def whole_number(cell: Column, dtype: str = "bigint") -> Column:
    """Integer in ``cell``; a decimal fraction is cut off, as in ``'12.0'``."""
    trimmed = F.trim(cell)
    cut = F.when(trimmed.rlike(r"^[+-]?\d+\.\d*$"), F.substring_index(trimmed, ".", 1))
    return F.coalesce(cell.try_cast(dtype), cut.try_cast(dtype))


def real_number(cell: Column) -> Column:
    return cell.try_cast("double")


def instant(cell: Column) -> Column:
    """Timestamp in ``cell``, or null."""
    return F.try_to_timestamp(cell)


def day_text(cell: Column) -> Column:
    """ISO day of a date-like text, or null."""
    return cell.try_cast("date").cast("string")


def settled_day(dt: Column, ts: Column) -> Column:
    """``dt`` if it has ten characters, else the day of ``ts``.

    The ten characters are not checked further: they are a partition key given
    by the producer, and any such text is kept.
    """
    return F.when(F.length(dt) == 10, dt).otherwise(F.to_date(ts).cast("string"))


def or_unknown(cell: Column) -> Column:
    return F.coalesce(cell, F.lit(UNKNOWN))


def filled(cell: Column) -> Column:
    """True for text with something other than blanks; null for null."""
    return F.length(F.trim(cell)) > 0


def one_of(cell: Column, domain: Iterable[str]) -> Column:
    return cell.isin(*domain)


def between_open(number: Column, low: float, high: float) -> Column:
    """``low < number < high``. NaN sorts above every number, so it fails."""
    return (number > low) & (number < high)


def from_up_to(number: Column, low: float, high: float) -> Column:
    """``low <= number < high``, NaN failing as above."""
    return (number >= low) & (number < high)


def is_float_text(cell: Column) -> Column:
    return cell.rlike(FLOAT_TEXT)


def first_forwarded(forwarded_for: Column, peer: Column) -> Column:
    """Client address: first entry of a forwarded-for list, else the peer's.

    A list that begins with a comma gives an empty address, not the peer's.
    """
    head = F.btrim(F.substring_index(forwarded_for, ",", 1), F.lit(ASCII_SPACE))
    return F.when(F.length(forwarded_for) > 0, head).otherwise(or_unknown(peer))


def given(cell: Column) -> Column:
    """``cell`` with empty text turned into null."""
    return F.when(F.length(cell) > 0, cell)

"""Typed conversions with explicit strict vs tolerant behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"  # the warehouse NUMERIC type


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def strict_cast(c, to: str) -> Column:
    """FN-6: CAST; bad input fails the query (session runs with ANSI on)."""
    return _c(c).cast(to)


def safe_cast(c, to: str) -> Column:
    """FN-7: SAFE_CAST; bad input -> NULL."""
    return _c(c).try_cast(to)


# Text that is a number; Spark's casts alone would also take '12d' or 'NaN'.
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_numeric_coerce(c) -> Column:
    """FN-16: numeric text (also '12.0', ' 7 ', '1e3') -> BIGINT, other ->
    NULL.  All 64 bits of a whole number are kept; fractions are truncated
    towards zero; a number beyond 64 bits is NULL."""
    text = F.trim(_c(c).cast("string"))
    whole = F.coalesce(text.try_cast("bigint"), F.floor(F.abs(text.try_cast("decimal(38,9)"))).try_cast("bigint")
                       * F.when(text.startswith("-"), -1).otherwise(1))
    return F.when(text.rlike(NUMBER_TEXT), whole)


# The field order of each date shape.  In a shape Y is a run of
# four digits, N a run of one or two, A a word; other characters stand for
# themselves.
DATE_SHAPES = {
    "YMD": ("Y-N-N", "Y/N/N", "Y.N.N", "Y N N", "Y-A-N", "Y A N"),
    "MDY": ("N/N/Y", "N-N-Y", "N.N.Y", "A N, Y", "A N Y", "A-N-Y"),
    "DMY": ("N A Y", "N-A-Y", "N/A/Y", "N A, Y"),
    "YM": ("Y-N", "Y/N"),
    "Y": ("Y",),
}

# Month and weekday names; three letters are enough.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

_CLOCK = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d{1,9})?)?"
_HALF_DAY = r"(0?[1-9]|1[0-2])(:[0-5]\d){1,2} ?[ap]m"
_ZONE = r" ?(z|utc|gmt|[+-]([01]\d|2[0-3])(:?[0-5]\d)?)"
_TIME = rf"(?:(?:t| +)(?:{_HALF_DAY}|{_CLOCK})(?:{_ZONE})?)?"


def _any_name(names) -> str:
    return "|".join(f"{n[:3]}({n[3:]})?" if n[3:] else n for n in names)


def to_date_coerce(c) -> Column:
    """FN-17: tolerant date parse of one literal (``pandas.to_datetime`` value
    by value with ``errors='coerce'``, then ``.date``); unparsable -> NULL.

    The shape of the literal's date part selects the field order from
    ``DATE_SHAPES``; ``20240105`` counts as ``2024-01-05``.  A month is a number
    or an English name.  Month-first shapes are read day first where the first
    number exceeds 12.  A missing month or day is 1.  A weekday in front, and a
    time of day with fraction and zone behind, must be well-formed; the date is
    the written one, whatever the zone."""
    text = F.trim(_c(c).cast("string"))
    plain = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), plain).otherwise(_computed_once(_date_part(F.lower(text)), _date_by_shape))


def _computed_once(value: Column, use) -> Column:
    """``use(value)`` where ``use`` names the value many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _date_part(text: Column) -> Column:
    text = F.regexp_replace(text, rf"^(?:{_any_name(WEEKDAYS)}),? +", "")
    date = F.regexp_extract(text, rf"^(.+?){_TIME}$", 1)
    date = F.regexp_replace(date, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    shape = F.regexp_replace(date, "[a-z]+", "A")
    shape = F.regexp_replace(shape, r"(?<!\d)\d{4}(?!\d)", "Y")
    shape = F.regexp_replace(shape, r"(?<!\d)\d{1,2}(?!\d)", "N")
    return F.struct(shape.alias("shape"), F.regexp_extract_all(date, F.lit("([a-z]+|[0-9]+)"), F.lit(1)).alias("fields"))


def _date_by_shape(date: Column) -> Column:
    shape, fields = date["shape"], date["fields"]

    def part(letter):
        out = F.lit(None).cast("string")
        for order, shapes in DATE_SHAPES.items():
            at = F.get(fields, F.lit(order.index(letter))) if letter in order else F.lit("1")
            out = F.when(shape.isin(*shapes), at).otherwise(out)
        return out

    names = F.lit("".join(m[:3] for m in MONTHS))
    month = part("M")
    # "sept" is the one other short form in use
    named = F.when(month.rlike(rf"^(?:{_any_name(MONTHS)}|sept)$"), ((F.instr(names, F.substring(month, 1, 3)) + 2) / 3).cast("int"))
    month = F.when(month.rlike("^[0-9]+$"), month.try_cast("int")).otherwise(named)
    day = part("D").try_cast("int")
    swap = shape.isin("N/N/Y", "N-N-Y", "N.N.Y") & (month > 12)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    first, second = F.when(swap, day).otherwise(month), F.when(swap, month).otherwise(day)
    return F.try_to_date(F.concat(part("Y"), F.lit("-"), two(first), F.lit("-"), two(second)), "yyyy-MM-dd")


def int_or_default(c, default: int = 0) -> Column:
    """FN-18 for a plain column: NULL counts as absent; any other value must
    convert or the query fails."""
    return F.coalesce(_c(c).cast("bigint"), F.lit(default).cast("bigint"))


def date_of(c) -> Column:
    """FN-8: DATE(string | timestamp) in the session time zone (UTC)."""
    return F.to_date(_c(c))


def epoch_to_timestamp(c) -> Column:
    """FN-9: TIMESTAMP_SECONDS."""
    return F.timestamp_seconds(_c(c))

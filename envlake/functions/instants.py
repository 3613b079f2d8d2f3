"""Instants: strict parsing with an explicit zone, and display."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Extended or basic ISO 8601: day, hour, optional minute and second with fraction, zone.
ZONED = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))[T ](\d{2})(?::?(\d{2})(?::?(\d{2})([.,]\d+)?)?)?"
    r"(Z| UTC|[+-]\d{2}(?::?\d{2})?)$"
)
PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)$"
DATE = r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))$"

# Range of instants that 64-bit nanoseconds can hold.
INSTANT_RANGE = ("1677-09-21 00:12:43.145225Z", "2262-04-11 23:47:16.854775Z")

# Month names and zone of the display text.
DISPLAY_MONTHS = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sept", "Oct", "Nov", "Dec",
)
DISPLAY_ZONE = "Africa/Johannesburg"
DISPLAY_ZONE_LABEL = "SAST"
NOT_AVAILABLE = "Not available"


def parse_instant(text: Column) -> Column:
    """Instant of ISO text that names its zone; null otherwise.

    Basic and hour-only spellings are written out first. Instants outside the range of
    64-bit nanoseconds count as unreadable.
    """
    at = F.regexp_replace(text, ZONED, "$1-$2$4-$3$5T$6:0$7:0$8$9$10")
    # A part that is there makes its place three digits long; the first zero goes.
    full = F.regexp_replace(F.regexp_replace(at, r":0(\d{2})", ":$1"), r":0(?=[:Z+-])", ":00")
    spelled = F.when(text.rlike(PLAIN), text).when(text.rlike(ZONED), F.replace(F.replace(full, F.lit(","), F.lit(".")), F.lit(" UTC"), F.lit("Z")))
    instant = spelled.try_cast("timestamp")
    low, high = (F.lit(bound).cast("timestamp") for bound in INSTANT_RANGE)
    return F.when(instant.between(low, high), instant)


def nanosecond_remainder(text: Column) -> Column:
    """Nanoseconds (0-999) that a microsecond timestamp cannot hold."""
    digits = F.rpad(F.regexp_extract(text, r"[.,]\d{6}(\d{1,3})", 1), 3, "0")
    return F.when(text.rlike(r"[.,]\d{7}"), digits).otherwise("0").try_cast("smallint")


def parse_date(text: Column) -> Column:
    """Date of ``YYYY-MM-DD`` or ``YYYYMMDD`` text; null otherwise."""
    return F.when(text.rlike(DATE), F.regexp_replace(text, DATE, "$1-$2$4-$3$5").try_cast("date"))


def iso_utc(instant: Column) -> Column:
    """ISO text in UTC ending in Z; the fraction appears only when not zero."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(instant, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("Z"))


def canonical_utc(instant: Column, nanoseconds: Column) -> Column:
    """One spelling per instant, nanoseconds included."""
    nanos = F.when(nanoseconds != 0, F.lpad(nanoseconds.cast("string"), 3, "0")).otherwise("")
    fraction = F.date_format(instant, ".SSSSSS")
    shown = F.when((fraction == ".000000") & (nanos == ""), "").otherwise(F.concat(fraction, nanos))
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), shown, F.lit("Z"))


def compact_label(text: Column) -> Column:
    """Window label usable in a path: ISO text without dashes and colons."""
    return F.translate(text, "-:", "")


def display_instant(instant: Column) -> Column:
    """Instant as local display text; null becomes the not-available text."""
    local = F.from_utc_timestamp(instant, DISPLAY_ZONE)
    month = F.element_at(F.array(*map(F.lit, DISPLAY_MONTHS)), F.month(local))
    text = F.concat_ws(
        " ",
        F.dayofmonth(local).cast("string"),
        month,
        F.concat(F.year(local).cast("string"), F.lit(",")),
        F.date_format(local, "HH:mm"),
        F.lit(DISPLAY_ZONE_LABEL),
    )
    return F.when(instant.isNull(), NOT_AVAILABLE).otherwise(text)


def display_bucket(day: Column) -> Column:
    """Start of a UTC day shown in the display zone."""
    return display_instant(day.cast("timestamp"))


def display_short_date(day: Column) -> Column:
    """Day and month of a UTC day's start in the display zone."""
    local = F.from_utc_timestamp(day.cast("timestamp"), DISPLAY_ZONE)
    month = F.element_at(F.array(*map(F.lit, DISPLAY_MONTHS)), F.month(local))
    return F.concat_ws(" ", F.dayofmonth(local).cast("string"), month)

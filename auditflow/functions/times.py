"""Date-time text to epoch milliseconds and back, in the session time zone or a named one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# A prefix match: signs, blanks before a number, fields of any length and any text after the seconds.
_FIELD = r"[ \t]*(-?[0-9]+)"
_LENIENT = f"^{_FIELD}-{_FIELD}-{_FIELD} {_FIELD}:{_FIELD}:{_FIELD}"

# Fields of more digits than this are beyond any time, even where one makes up for another.
_DIGITS = 25
# 400 years repeat, by the month and by the day.
_MONTHS, _DAYS, _DAY = 4_800, 146_097, 86_400
# Seconds either side of 1970 that a timestamp can hold, less two days for the zone.
_MOST = 9_223_372_036_854 - 2 * _DAY


def _whole(number: Column) -> Column:
    return number.cast("decimal(38,0)")


def _rolled_time(text: Column) -> Column:
    """Read signed, unpadded or out-of-range fields by calendar arithmetic (month 13 is next January).

    Fields are exact whole numbers. Months are split into spans of 400 years, which have equally many
    days, and a month of such a span; days and the clock are added to the first of that month. Null
    where the text has no six fields or the time is beyond what a timestamp holds.
    """

    def field(i: int) -> Column:
        found = F.regexp_extract(text, _LENIENT, i)
        short = F.regexp_replace(found, "^(-?)0+(?=[0-9])", "$1")
        return F.when(F.length(F.ltrim(short, F.lit("-"))) <= _DIGITS, short.try_cast(f"decimal({_DIGITS},0)"))

    year, month, day, hour, minute, second = map(field, range(1, 7))
    months = _whole(year * 12 + month - 1)
    of_span = F.pmod(months, F.lit(_MONTHS)).cast("int")
    spans = _whole((months - of_span) / _MONTHS)
    first = F.date_diff(F.add_months(F.lit("2000-01-01").cast("date"), of_span), F.lit("1970-01-01").cast("date"))
    days = _whole((spans - 5) * _DAYS) + first + day - 1
    seconds = _whole(_whole(days * _DAY) + hour * 3_600 + minute * 60 + second)
    clock = F.pmod(seconds, F.lit(_DAY))
    known = F.when(F.abs(seconds) <= _MOST, seconds)
    day_number = ((known - clock) / _DAY).cast("int")
    since = F.make_dt_interval(day_number, F.lit(0), F.lit(0), clock.cast("decimal(18,6)"))
    return (F.lit("1970-01-01").cast("timestamp_ntz") + since).cast("timestamp")


def parse_time_ms(text: Column, lenient: bool = True, zone: str | None = None) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss`` text, null where it cannot be read.

    Well-formed text takes the first branch; only other text pays for the lenient reading. With a
    ``zone`` the text is a time there, whatever zone the session has, as long as the session's own
    clock does not skip that time. A time that the zone's clock skips is moved on by the gap.
    """
    # Longer text is never well-formed, and some years of more digits would raise an error there.
    padded = F.when(F.length(text) <= len("-0001-01-01 00:00:00"), text)
    strict = F.try_to_timestamp(padded, F.lit(TIME_FORMAT))
    found = F.coalesce(strict, _rolled_time(text)) if lenient else strict
    if not zone:
        return F.unix_millis(found)
    there = F.convert_timezone(F.lit(zone), F.lit("UTC"), found.cast("timestamp_ntz"))
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), there)


def format_time(ms: Column, zone: str | None = None) -> Column:
    moment = F.timestamp_millis(ms)
    if not zone:
        text = F.date_format(moment, TIME_FORMAT)
    else:
        there = F.convert_timezone(F.current_timezone(), F.lit(zone), moment.cast("timestamp_ntz"))
        text = F.date_format(there, TIME_FORMAT)
    # Years of more than four digits come with a sign.
    return F.ltrim(text, F.lit("+"))

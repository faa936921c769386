"""Timestamp parsing and calendar parts.

Two timestamp dialects exist in the sales pipeline:

* ``ts_iso``: Python ``datetime.fromisoformat`` (3.13 rules) -- the wall clock
  is kept and a UTC offset is *not* applied (``10:30+05:30`` -> hour 10); ``instant`` applies it.
* ``ts_pattern``: ``TO_TIMESTAMP(s, 'yyyy-MM-dd HH:mm:ss')`` of the SQL job,
  NULL when the text does not parse.

Both return TIMESTAMP_NTZ, so the session time zone never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 texts accepted by Python's fromisoformat (3.13).  The date part (extended, basic,
# week) and the time part (extended, basic) are independent of each other; any one character
# separates them; the offset follows the time.
ISO_DATES = [
    r"([0-9]{4})-([0-9]{2})-([0-9]{2})",        # year, month, day
    r"([0-9]{4})([0-9]{2})([0-9]{2})",
    r"([0-9]{4})-W([0-9]{2})(?:-([1-7]))?",     # ISO year, week, weekday
    r"([0-9]{4})W([0-9]{2})([1-7])?",
]
ISO_TIMES = [
    r"([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?)?",
    r"([0-9]{2})(?:([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?)?",
]
ISO_OFFSET = r"(Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9](?::?[0-5][0-9](?:[.,][0-9]+)?)?)?)?"
# All of them in one pattern.  Its groups: 1-3, 4-6 year, month, day; 7-9, 10-12 year, week, weekday; 13-16, 17-20 hour, minute,
# second, fraction; 21 offset.
ISO = "^(?:" + "|".join(ISO_DATES) + ")(?:(?s:.)(?:" + "|".join(ISO_TIMES) + ")" + ISO_OFFSET + r")?\z"
# What a text is rewritten to, a part that it doesn't state being empty.
ISO_PARTS = "$1$4-$2$5-$3$6|$7$10|$8$11|$9$12|$13$17|$14$18|$15$19|$16$20"
ISO_OFFSET_GROUP = 21
SQL_PATTERN = "yyyy-MM-dd HH:mm:ss"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The shape producers emit; Spark's own cast reads it directly.
ISO_SIMPLE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _iso_text(parts: Column) -> Column:
    """``ISO_PARTS`` of a text, split -> the wall clock as text that Spark's cast reads; NULL for an impossible date."""
    date, year, week, weekday, h, m, sec, frac = (F.get(parts, F.lit(i)) for i in range(8))
    # week 1 holds January 4th; an ISO year holds its weeks' Thursdays
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week.try_cast("int") - 1) * 7)
    of_week = F.when(F.year(F.date_add(monday, 3)) == year.try_cast("int"),
                     F.date_add(monday, F.when(weekday == "", 0).otherwise(weekday.try_cast("int") - 1)))

    def or_zero(x: Column) -> Column:
        return F.when(x == "", "00").otherwise(x)

    return F.concat(F.when(year == "", date).otherwise(of_week.cast("string")), F.lit("T"), or_zero(h), F.lit(":"), or_zero(m),
                    F.lit(":"), or_zero(sec), F.lit("."), F.rpad(F.substr(frac, F.lit(1), F.lit(6)), 6, "0"))


def ts_iso(s: Column | str) -> Column:
    """``datetime.fromisoformat(s)`` as TIMESTAMP_NTZ (offset dropped), NULL when
    Python would raise (bad text, empty, null, impossible dates, year 0).

    Pass a column, not a large expression: the text is read several times.
    Cost per row: one regex for the common ``yyyy-MM-dd[T ]HH:mm:ss`` shape, which Spark's cast reads; two more for any
    other text, of which the second cuts all parts at once."""
    s = _c(s)
    # a lambda's variable is computed once, however often it is read
    parts = F.array(F.split(F.regexp_replace(s, ISO, ISO_PARTS), "[|]", -1))
    general = F.when(s.rlike(ISO), F.get(F.transform(parts, _iso_text), F.lit(0)))
    text = F.when(s.rlike(ISO_SIMPLE), s).otherwise(general)
    # Spark accepts year 0000, Python's datetime does not
    return F.when(~s.startswith("0000"), text.try_cast("timestamp_ntz"))


def _offset_seconds(o: Column) -> Column:
    digits = F.regexp_replace(o, "[.,].*|:", "")
    east = (F.coalesce(F.substr(digits, F.lit(2), F.lit(2)).try_cast("int"), F.lit(0)) * 3600
            + F.coalesce(F.substr(digits, F.lit(4), F.lit(2)).try_cast("int"), F.lit(0)) * 60
            + F.coalesce(F.substr(digits, F.lit(6), F.lit(2)).try_cast("int"), F.lit(0)))
    return F.when(o.startswith("-"), -east).otherwise(east)


def iso_offset(s: Column | str) -> Column:
    """Seconds east of UTC that an ISO text states; 0 when it states none."""
    s = _c(s)
    stated = F.get(F.transform(F.array(F.regexp_extract(s, ISO, ISO_OFFSET_GROUP)), _offset_seconds), F.lit(0))
    return F.when(s.rlike(ISO_SIMPLE) | ~s.rlike(r"[+-][0-9:.,]*\z"), 0).otherwise(stated)


def instant(wall: Column | str, text: Column | str) -> Column:
    """The UTC clock of a wall clock that ``text`` states with its offset (none: UTC already)."""
    wall, text = _c(wall), _c(text)
    # a text without a sign behind its date states none, or Z
    return F.when(text.rlike(ISO_SIMPLE) | text.endswith("Z"), wall) \
        .otherwise(wall - F.make_dt_interval(secs=iso_offset(text).cast("decimal(18,6)")))


# The SQL job's one pattern as a regex: the text must have exactly this shape.
SQL_PATTERN_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"

# English day and month names.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")


def ts_pattern(s: Column | str, fmt: str = SQL_PATTERN) -> Column:
    """``TO_TIMESTAMP(s, fmt)`` that yields NULL instead of failing (ANSI).

    For the SQL job's pattern the shape is checked by regex and the text cast
    straight to TIMESTAMP_NTZ: ``try_to_timestamp`` parses into the session
    zone, which moves wall-clock times that fall into a DST gap."""
    s = _c(s)
    if fmt == SQL_PATTERN:
        return F.when(s.rlike(SQL_PATTERN_RE), s.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")


def date_id_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd`` of a TIMESTAMP_NTZ.  ``date_format`` would go through the
    session zone (an NTZ value in a DST gap comes out an hour later)."""
    return F.to_date(_c(ts)).cast("string")


def day_name(ts: Column | str) -> Column:
    """Full English weekday name, e.g. ``Thursday`` (zone-free lookup)."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.dayofweek(F.to_date(_c(ts))))


def month_name(d: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.element_at(names, F.month(F.to_date(_c(d))))


def dow_sunday0(d: Column | str) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_c(d)) - 1


def padded_name(d: Column | str, pattern: str, width: int = 9) -> Column:
    """Month (``MMMM``) / day (``EEEE``) name blank-padded to ``width``
    (``TO_CHAR(d, 'Month')`` / ``'Day'``)."""
    name = month_name(d) if pattern == "MMMM" else day_name(d)
    return F.rpad(name, width, " ")


def minute_bucket(ts: Column | str) -> Column:
    """``date_trunc('minute', ts)`` for TIMESTAMP_NTZ without a time-zone trip.

    ``F.date_trunc`` returns a zoned TIMESTAMP: NTZ input goes through the
    session zone and comes back shifted around DST changes.  Subtracting the
    seconds (with their fraction) is zone-free."""
    t = _c(ts)
    return t - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), t))


_EPOCH_NTZ = "1970-01-01 00:00:00"
_MICROS_PER_DAY = 86_400_000_000


def ntz_to_instant(ts: Column | str) -> Column:
    """Wall clock (TIMESTAMP_NTZ) read as UTC -> TIMESTAMP, without the session
    zone (a watermark needs a zoned TIMESTAMP column)."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.to_date(F.lit("1970-01-01"))).cast("bigint")
    secs = F.hour(t) * 3600 + F.minute(t) * 60 + F.extract(F.lit("SECOND"), t)
    return F.timestamp_micros(days * _MICROS_PER_DAY + (secs * 1_000_000).cast("bigint"))


def instant_to_ntz(ts: Column | str) -> Column:
    """Inverse of ``ntz_to_instant``: UTC wall clock of an instant as NTZ."""
    micros = F.unix_micros(_c(ts))
    days = F.floor(micros / _MICROS_PER_DAY).cast("int")
    rest = (micros - days.cast("bigint") * _MICROS_PER_DAY).cast("decimal(18,0)") / 1_000_000
    return (F.lit(_EPOCH_NTZ).cast("timestamp_ntz")
            + F.make_dt_interval(days=days, secs=rest.cast("decimal(18,6)")))

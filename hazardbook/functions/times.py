"""Dates and timestamps parsed from text, independent of the session time zone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardbook.functions.once import once
from hazardbook.functions.strings import strip

_USUAL_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_USUAL_TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
)
_OFFSET = r"[0-9]{2}:[0-9]{2}.*([+-][0-9]{2}:?[0-9]{2})$"

# ISO-8601 in full: calendar or week dates, with or without separators; then any one
# character and a time that may stop after the hour or the minute, an offset likewise.
# Every part is a group; a text of another form matches too, with all groups empty.
_DAY = (
    "([0-9]{4})(?:-([0-9]{2})-([0-9]{2})|-W([0-9]{2})(?:-([0-9])(?![0-9]))?"
    "|W([0-9]{2})([0-9])?|([0-9]{2})([0-9]{2}))"
)
_HOUR, _SIXTY, _PART = "([01][0-9]|2[0-3])", "([0-5][0-9])", "(?:[.,]([0-9]+))?"
_TIME = f"(?:{_HOUR}(?::{_SIXTY}(?::{_SIXTY}{_PART})?)?|{_HOUR}{_SIXTY}(?:{_SIXTY}{_PART})?)"
_ANY_DAY = f"(?s)^(?:{_DAY}$(.*)|.*)"
_ANY_MOMENT = f"(?s)^(?:{_DAY}(?:[^0-9]{_TIME}(?:Z|([+-]){_TIME})?|Z)?$.*|.*)"
# Year, month, day, week and day of the week; hour, minute, second and fraction; the
# offset's sign and the same of the offset. Of two groups at most one is not empty.
_DAY_PARTS = "$1,$2$8,$3$9,$4$6,$5$7"
_MOMENT_PARTS = _DAY_PARTS + ",$10$14,$11$15,$12$16,$13$17,$18,$19$23,$20$24,$21$25,$22$26"


def _of_parts(text: Column, form: str, parts: str, build: Callable[[Column], Column]) -> Column:
    """What ``build`` makes of the parts of a text, which is matched once."""
    return once(F.when(text.isNotNull(), F.split(F.regexp_replace(text, form, parts), ",")), build)


def _seconds(parts: Column, at: int) -> Column:
    """The time of day whose parts begin at ``at`` as an interval; empty parts are zero."""

    def two(part: int) -> Column:
        return F.rpad(parts[part], 2, "0")

    micros = F.rpad(parts[at + 3], 6, "0")  # cuts off what is longer
    whole = F.concat(two(at + 2), F.lit("."), micros).try_cast("decimal(8,6)")
    return F.make_dt_interval(
        hours=two(at).try_cast("int"), mins=two(at + 1).try_cast("int"), secs=whole
    )


def _day(parts: Column) -> Column:
    """A date in any of the forms of ``_DAY``. Week 53 of a year without one is no date."""
    dashed = F.concat_ws("-", parts[0], parts[1], parts[2])
    year, week = parts[0].try_cast("int"), parts[3].try_cast("int")
    weekday = F.coalesce(parts[4].try_cast("int"), F.lit(1))
    fourth = F.when(year > 0, F.make_date(year, F.lit(1), F.lit(4)))  # always in week 1
    monday = F.date_add(F.trunc(fourth, "week"), (week - 1) * 7)
    real = (F.weekofyear(monday) == week) & weekday.between(1, 7)
    of_week = F.when(real, F.date_add(monday, weekday - 1))
    return F.when(parts[3] != "", of_week).when(parts[1] != "", dashed.try_cast("date"))


def _moment(parts: Column) -> Column:
    at, offset = _day(parts).cast("timestamp_ntz") + _seconds(parts, 5), _seconds(parts, 10)
    return F.when(parts[9] == "+", at - offset).when(parts[9] == "-", at + offset).otherwise(at)


def _any_timestamp(text: Column) -> Column:
    """Any ISO-8601 text to a zone-less UTC timestamp."""
    return _of_parts(text, _ANY_MOMENT, _MOMENT_PARTS, _moment)


def usual_timestamp(text: Column) -> Column:
    """What ``iso_timestamp`` gives for a text in the usual form, NULL for others.

    The wall-clock part is cast without a zone and the offset is subtracted, so a
    session time zone other than UTC gives the same answer. The usual text ends in
    ``Z`` and skips the offset.
    """
    wall = text.try_cast("timestamp_ntz")
    offset = F.replace(F.regexp_extract(text, _OFFSET, 1), F.lit(":"))
    hours = F.substring(offset, 1, 3).try_cast("int")
    minutes = F.concat(F.substring(offset, 1, 1), F.substring(offset, 4, 2)).try_cast("int")
    shifted = wall - F.make_dt_interval(hours=hours, mins=minutes)
    usual = F.when(text.endswith("Z") | ~text.rlike(_OFFSET), wall).otherwise(shifted)
    return F.when(text.rlike(_USUAL_TIMESTAMP), usual)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to a zone-less UTC timestamp, NULL when it is not one. Rare forms are
    taken apart."""
    return F.coalesce(usual_timestamp(text), _any_timestamp(text))


def iso_date(text: Column, *, trim: bool = False) -> Column:
    """ISO-8601 calendar or week date to a date. The shape is checked first because a
    plain cast would also accept ``2024`` and ``2024-1-1``."""
    value = strip(text) if trim else text
    return F.when(value.rlike(_USUAL_DATE), value.try_cast("date")).otherwise(
        _of_parts(value, _ANY_DAY, _DAY_PARTS.replace("$9", "$9$10"), _day)  # with its line end
    )


def first_iso_date(text: Column) -> Column:
    """The first ``YYYY-MM-DD`` anywhere in the text, if it is a valid date."""
    return F.regexp_extract(text, "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).try_cast("date")


def date_in_file_name(path: Column, prefix: str, suffix: str) -> Column:
    """Date of a file named ``<prefix>YYYY-MM-DD<suffix>``, else NULL."""
    pattern = rf"{prefix}([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){suffix}$"
    return F.regexp_extract(path, pattern, 1).try_cast("date")


def year_in_file_name(path: Column, prefix: str, suffix: str) -> Column:
    """Year of a file named ``<prefix>YYYY<suffix>`` or ``<prefix>YYYY-MM-DD<suffix>``."""
    pattern = rf"{prefix}([0-9]{{4}})(-[0-9]{{2}}-[0-9]{{2}})?{suffix}$"
    return F.regexp_extract(path, pattern, 1).try_cast("int")


def first_year(*candidates: Column, default: Column | None = None) -> Column:
    """Year of the first non-NULL date, then ``default``."""
    year = F.year(F.coalesce(*candidates))
    return year if default is None else F.coalesce(year, default)

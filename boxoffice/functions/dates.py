"""Date keys, hour labels and tolerant parsing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """A date or timestamp as the integer ``yyyymmdd``."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def key_to_date(c: Column) -> Column:
    """The date that an integer ``yyyymmdd`` stands for."""
    return F.to_date(c.cast("string"), "yyyyMMdd")


def hour_label(c: Column) -> Column:
    """The hour on a 12-hour clock, such as ``01 PM``."""
    labels = [f"{(h + 11) % 12 + 1:02d} {'AM' if h < 12 else 'PM'}" for h in range(24)]
    return F.elt(F.hour(c) + 1, *[F.lit(label) for label in labels])


def clock_time(c: Column) -> Column:
    """The time of day as ``HH:mm:ss``, read off the text so that no zone can shift it."""
    return F.substring(c.cast("string"), 12, 8)


def parse_mixed(c: Column, formats: Sequence[str]) -> Column:
    """Parse text that mixes formats; text that fits none gives null."""
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


# The range of dates that fit a 64-bit count of nanoseconds, and the words of dates.
FIRST_DATE, LAST_DATE = dt.date(1677, 9, 22), dt.date(2262, 4, 11)
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_NAME = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sept?|september|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
WEEKDAY = "mon(?:day)?|tue(?:s|sday)?|wed(?:nesday)?|thu(?:rs|rsday|r)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?"

_ZONE = r"(?:z|[a-z]{3,4}|[+-]\d{2}(?::?\d{2})?)"
_HALF = r"(?:\s*(?:am|pm))"
#: A time of day: hours and minutes, or an hour with am or pm, and a zone only at the end.
_TIME = (
    rf"(?:^|(?:\bat)?[\s,]+|(?<=\d)t)(?:(\d{{1,2}}):(\d{{1,2}})(?::(\d{{1,2}})(?:[.,]\d+)?)?({_HALF})?(?:\s*{_ZONE}$)?"
    rf"|(\d{{1,2}})({_HALF}))(?=$|[\s,])"
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _number(token: Column) -> Column:
    return F.try_to_number(token, F.lit("99999999")).cast("int")


def _full_year(token: Column, this_year: int) -> Column:
    """A year of four digits, or of one or two that lies from 50 years ago to 49 years ahead."""
    number, century = _number(token), this_year // 100 * 100
    near = number + century
    near = F.when(near >= this_year + 50, near - 100).when(near < this_year - 50, near + 100).otherwise(near)
    return F.when(F.length(token) == 4, number).when(F.length(token) <= 2, near)


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def _month(token: Column) -> Column:
    """The number of a month's name; 0 for anything else."""
    place = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(token, 1, 3))
    return F.when(token.rlike(f"^(?:{MONTH_NAME})$"), place).otherwise(0).cast("int")


def _one_token(t: Column, this_year: int) -> Column:
    """A year, a quarter, or digits without separators."""
    first, rest = F.substring(t, 1, 4), lambda at, n=2: F.substring(t, at, n)
    hour_fits = (F.length(t) == 8) | ((_number(rest(9)) < 24) & (_number(rest(11)) < 60))
    return (
        F.when(t.rlike(r"^\d{4}$"), _day(_number(first), F.lit(1), F.lit(1)))
        .when(t.rlike(r"^\d{4}q[1-4]$"), _day(_number(first), _number(rest(6, 1)) * 3 - 2, F.lit(1)))
        .when(t.rlike(r"^\d{6}$"), _day(_full_year(rest(1), this_year), _number(rest(3)), _number(rest(5))))
        .when(t.rlike(r"^\d{8}(?:\d{4}(?:\d{2})?)?$") & hour_fits, _day(_number(first), _number(rest(5)), _number(rest(7))))
    )


def _two_tokens(a: Column, b: Column) -> Column:
    """A month and a year of four digits, in either order."""
    def month(t: Column) -> Column:
        return F.when(_month(t) > 0, _month(t)).when(t.rlike(r"^\d{1,2}$"), _number(t))

    year = lambda t: t.rlike(r"^\d{4}$")
    return F.when(year(a), _day(_number(a), month(b), F.lit(1))).when(year(b), _day(_number(b), month(a), F.lit(1)))


def _three_tokens(a: Column, b: Column, c: Column, this_year: int) -> Column:
    """Year first if only a year fits there; else the year is last and the month first, if it can be."""
    digits = lambda t: t.rlike(r"^(?:\d{1,2}|\d{4})$")
    is_year = lambda t: (F.length(t) == 4) | (_number(t) > 31)
    year = lambda t: _full_year(t, this_year)
    numbers = (
        F.when(is_year(a), _day(year(a), _number(b), _number(c)))
        .when(is_year(b), F.lit(None).cast("date"))
        .when(_number(a) > 12, _day(year(c), _number(b), _number(a)))
        .otherwise(_day(year(c), _number(a), _number(b)))
    )
    return (
        F.when(digits(a) & digits(b) & digits(c), numbers)
        .when(
            (_month(a) > 0) & digits(b) & digits(c),
            F.when(is_year(b), _day(year(b), _month(a), _number(c))).otherwise(_day(year(c), _month(a), _number(b))),
        )
        .when(
            digits(a) & (_month(b) > 0) & digits(c),
            F.when(is_year(a), _day(year(a), _month(b), _number(c))).otherwise(_day(year(c), _month(b), _number(a))),
        )
        .when(
            digits(a) & digits(b) & (_month(c) > 0),
            F.when(is_year(b), _day(year(b), _month(c), _number(a))).otherwise(_day(year(a), _month(c), _number(b))),
        )
    )


def _time_fits(s: Column) -> Column:
    """True if the text has no time of day, or one that exists."""
    part = lambda i: F.nullif(F.regexp_extract(s, _TIME, i), F.lit(""))
    hour = _number(F.coalesce(part(1), part(5)))
    half = F.coalesce(part(4), part(6))
    hours = F.when(half.isNotNull(), hour.between(0, 12)).otherwise(hour < 24)
    rest = (F.coalesce(_number(part(2)), F.lit(0)) < 60) & (F.coalesce(_number(part(3)), F.lit(0)) < 60)
    return ~s.rlike(_TIME) | (hours & rest)


def parse_date(c: Column, this_year: int) -> Column:
    """The date in a text of no fixed format; null for what is no date.

    The text is cut into tokens: digits, names of months, separators. A time of day with its
    zone, names of weekdays, endings of ordinals and the words at, on, of, and are skipped; the date is
    taken as written, in no zone. Read are three tokens (day, month and year), two (a month and
    a year of four digits: its first day), and one (a year, a quarter, or eight, six, twelve or fourteen digits,
    year first). Where day and month could change places, the month comes first; a first number that
    is no month is the day. A year of one or two digits is the one from 50 years before
    ``this_year`` to 49 years after it. Dates outside FIRST_DATE to LAST_DATE are null.
    Not read: ``today``, ``now``, times without a date, months in other languages, week dates.
    """
    plain = F.lower(F.trim(c))

    def words(s: Column) -> Column:
        bare = F.regexp_replace(s, r"^(\d{8})t(\d{4}(?:\d{2})?)$", "$1$2")
        bare = F.regexp_replace(F.regexp_replace(bare, _TIME, " "), r"(?<=\d)t(?=\d)", " ")
        bare = F.regexp_replace(bare, rf"^(?:{WEEKDAY})\b[.,]?|\b(?:{WEEKDAY})[.,]?$", " ")
        bare = F.regexp_replace(bare, r"(?<=\d)(?:st|nd|rd|th)\b", "")
        bare = F.regexp_replace(bare, r"(?<=[\s\d])(?:at|on|of|and)(?=\s)", " ")
        return F.trim(F.regexp_replace(bare, r"[\s\-/.,;\\]+", " "))

    def read(t: Column) -> Column:
        n, at = F.size(t), lambda i: F.get(t, F.lit(i))
        whole = _three_tokens(at(0), at(1), at(2), this_year)
        # A year, a month, a day, and an hour without minutes.
        with_hour = at(0).rlike(r"^\d{4}$") & at(3).rlike(r"^\d{1,2}$") & (_number(at(3)) < 24)
        return (
            F.when(n == 1, _one_token(at(0), this_year))
            .when(n == 2, _two_tokens(at(0), at(1)))
            .when((n == 3) | ((n == 4) & with_hour), whole)
        )

    def whole(s: Column) -> Column:
        return F.when(_time_fits(s), _let(F.split(words(s), " "), read))

    iso = F.try_to_date(plain, "yyyy-MM-dd")
    found = F.when(plain.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso).otherwise(_let(plain, whole))
    return _let(found, lambda d: F.when(d.between(F.lit(FIRST_DATE), F.lit(LAST_DATE)), d))


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``, cut towards zero.

    The difference is taken as an interval: on times without a zone it is the same in
    every session, also across a change to summer time.
    """
    return (end - start).cast("interval minute").cast("bigint")


def whole_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, cut towards zero."""
    return (end - start).cast("interval second").cast("bigint")


def shift_date(c: Column, unit: str, n: int) -> Column:
    """Move a date by days, months or years; a missing day of month becomes the last one."""
    if unit == "day":
        return F.date_add(c, n)
    if unit == "month":
        return F.add_months(c, n)
    if unit == "year":
        return F.add_months(c, 12 * n)
    raise ValueError(f"unknown unit {unit!r}")


def month_index(c: Column) -> Column:
    """Months counted on one axis, so that neighbours differ by one across years."""
    return F.year(c) * 12 + F.month(c)


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")

"""Lenient dates: a table of forms read natively, an Arrow UDF for whatever is left.

A text is a date, a time of day, or both. The time is cut off first, then the date is held against
:data:`FORMS`. What a form names but the calendar does not have, and what no form names, goes to
the general parser, so the table decides only how fast a text is read.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Words the general parser knows, and the forms dates have in the feed (lower case).
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
OTHER_WORDS = ["at", "on", "and", "ad", "m", "t", "of", "st", "nd", "rd", "th", "sept",
               "h", "hour", "hours", "minute", "minutes", "s", "second", "seconds",
               "am", "a", "pm", "p", "utc", "gmt", "z", "inf", "infinity", "nan"]
SHORT = 3  # letters of a short name


def _either(names: list[str]) -> str:
    return "(?:" + "|".join(f"{n[:SHORT]}(?:{n[SHORT:]})?" for n in names) + ")"


MONTH, DAY = _either(MONTHS), _either(DAYS)
TIME = r"(?:^| |(?<=\d)t)(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?))?(?: ?(am|pm))?$"
ISO = r"^[1-9]\d{3}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2})?$"
MARK = "\x01"  # between the parts of a text that is cut up
#: A date and how its year, month and day are written apart; ``{year}`` and ``{month}`` are those
#: of the day a text without them is read on.
FORMS = [
    (r"([1-9]\d{3})([-/])(\d{1,2})\2(\d{1,2})", "$1 $3 $4"),
    (r"([1-9]\d{3})(\d{2})(\d{2})t?", "$1 $2 $3"),
    (rf"(?:{DAY},? )?({MONTH}) (\d{{1,2}}),? ([1-9]\d{{3}})", "$3 $1 $2"),
    (rf"(?:{DAY},? )?(\d{{1,2}})([ -])({MONTH})\2([1-9]\d{{3}})", "$4 $3 $1"),
    (rf"(?:{DAY},? )?({MONTH}) (\d{{1,2}})", "{year} $1 $2"),
    (r"(\d{1,2})", "{year} {month} $1"),
]
KNOWN_WORD = f"(?:{MONTH}|{DAY}|{'|'.join(OTHER_WORDS)})"
UNKNOWN_WORD = rf"(?<![a-z])(?!{KNOWN_WORD}(?![a-z]))[a-z]"


def _once(value: Column, then) -> Column:
    """``then(value)``, with the value worked out once however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _apart(text: Column, run_date: dt.date) -> Column:
    """Year, month and day of a text without a time, null for a form that is not listed."""
    apart = F.when(text == "", run_date.strftime("%Y %m %d"))
    for pattern, parts in FORMS:
        parts = parts.format(year=f"{run_date.year:04}", month=run_date.month)
        apart = apart.when(F.rlike(text, F.lit(f"^{pattern}$")),
                           F.regexp_replace(text, f"^{pattern}$", parts))
    return F.split(apart, " ")


def _month(month: Column) -> Column:
    """1 to 12: a number as it is, a name by where its short form stands among all of them."""
    place = F.position(F.left(month, F.lit(SHORT)), F.lit("".join(n[:SHORT] for n in MONTHS)))
    return F.when(month < "a", month).otherwise(
        ((place + SHORT - 1) / SHORT).cast("int").cast("string"))


def _day(text: Column, run_date: dt.date) -> Column:
    """``yyyy-m-d`` of the date."""
    return _once(_apart(text, run_date), lambda part: F.concat_ws(
        "-", part[0], _month(part[1]), part[2]))


def _hour(hour: Column, half: Column) -> Column:
    """The hour of 24; one that a half of the day does not have is null."""
    number = hour.cast("int")
    return F.when(half == "", hour).when(
        number.between(1, 12), (number % 12 + F.when(half == "pm", 12).otherwise(0)).cast("string"))


def listed_date(c: Column, run_date: dt.date) -> Column:
    """ISO text of the listed forms, null for anything else. Never sees the session zone."""
    def read(part):  # date, hour, minute, second, half of the day; or the date only
        clock = F.concat(_hour(part[1], part[4]), F.lit(":"), part[2], F.lit(":"),
                         F.when(part[3] == "", "00").otherwise(part[3]))
        timed = F.size(part) == 5
        day = _once(F.when(timed | (part[0] != ""), part[0]), lambda date: _day(date, run_date))
        return F.concat(day, F.lit(" "), F.when(timed, clock).otherwise("00:00:00"))

    cut = F.regexp_replace(F.lower(c), TIME, MARK.join(["", "$1", "$2", "$3", "$4"]))
    parts = F.when(~F.contains(c, F.lit(MARK)), F.split(cut, MARK))
    # Most texts are ISO and are not taken apart.
    apart = F.when(F.rlike(c, F.lit(ISO)), c).when(~no_date(c), _once(parts, read))
    # As text: formatting functions would take the time through the session zone.
    found = apart.try_cast("timestamp_ntz").cast("string")
    # A fraction is written with six digits or not at all.
    full = F.regexp_extract(F.concat(found, F.lit("000000")), r"^.{19}(\.\d{6})?", 0)
    return F.replace(full, F.lit(" "), F.lit("T"))


def no_date(c: Column) -> Column:
    """True for empty texts and for words without a number one of which no date has."""
    text = F.lower(c)
    return (text == "") | (F.rlike(text, F.lit("^[a-z ,;:/'-]+$"))
                           & F.rlike(text, F.lit(UNKNOWN_WORD)))


def lenient_date(c: Column, run_date: dt.date) -> Column:
    """ISO text of a free-form date; empty or unreadable gives null.

    Parts the text leaves out are taken from ``run_date``. Only values in a form that is not listed
    are parsed in Python; what the others gave goes through as it is, so it is worked out once.
    """
    start_of_day = dt.datetime.combine(run_date, dt.time())

    @F.pandas_udf(T.StringType())
    def parse_rest(texts: pd.DataFrame) -> pd.Series:
        from dateutil import parser

        def parse(value):
            try:
                return parser.parse(value, default=start_of_day).isoformat()
            except (ValueError, OverflowError):
                return None

        left = texts["rest"].notna()
        if not left.any():
            return texts["listed"]
        return texts["listed"].mask(left, texts["rest"][left].map(parse))

    return parse_rest(_once(listed_date(c, run_date), lambda listed: F.struct(
        listed.alias("listed"),
        F.when(listed.isNull() & ~no_date(c), c).alias("rest"))))


def lenient_timestamp(c: Column, run_date: dt.date) -> Column:
    return lenient_date(c, run_date).try_cast("timestamp_ntz")

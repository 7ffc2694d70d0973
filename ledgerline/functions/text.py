"""Repair of untidy text: blanks, dirty integers, dirty numbers, dirty timestamps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "missing" once a cell is trimmed.
MISSING_AFTER_TRIM = ("", "nan", "None")

# White space that is trimmed from cells.
WHITE_SPACE = " \t\n\x0b\x0c\r\xa0"

# Fixed patterns for numbers. A cast of text that is no number raises and catches an error per row, so
# every cast below is guarded by a pattern.
WHOLE_NUMBER = r"^([+-]?[0-9]{1,19})(?:\.0*)?$"
PLAIN_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
PREFIXED_CODE = r"(?i)^[a-z_\-]*([0-9]+(?:\.[0-9]+)?)$"
COUNT_BAND = r"(?i)^([0-9]+(?:\.[0-9]+)?)\s*(k)?\+"
# One look settles most cells: an unsigned integer of up to 18 digits, plain or in a code; any other cell is read by the
# patterns above, which read these alike.
SHORT_INTEGER = r"^(?:[A-Za-z_][A-Za-z_\-]*|-[A-Za-z_\-]+)?([0-9]{1,18})(?:\.0+)?$"
NUMBER_ALONE = r"^-?[0-9]+(?:\.[0-9]+)?\z"

# Fixed patterns: spellings of a date, each with an optional time, half of the day and offset from UTC. No two begin alike.
CLOCK = r"(?:,?[ T]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{1,2}(?:\.[0-9]{1,6})?)[0-9]*)?)?"
HALF_AND_ZONE = r" ?([AaPp][Mm])? ?(Z|z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})?$"
DATE_FORMS = {
    "year_first": r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})",
    "compact": r"([0-9]{4})([0-9]{2})([0-9]{2})",
    "year_last": r"([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4}|[0-9]{2})",
    "day_month_name": r"([0-9]{1,2})[-/ .]+([A-Za-z]{3})[a-z]*[-/ .,]+([0-9]{4}|[0-9]{2})",
    "month_name_day": r"([A-Za-z]{3})[a-z]*[. ]+([0-9]{1,2})(?:st|nd|rd|th)?,? +([0-9]{4})",
}
ANY_DATE = "^(?:" + "|".join(DATE_FORMS.values()) + ")" + CLOCK + HALF_AND_ZONE
# The parts of a date by the groups of the one spelling that matched; the other groups are empty. Only ``year_last``
# has the first part.
ANY_ORDER = "$7|$1$4$9$12$15|$2$5$7$11$13|$3$6$8$10$14|$16|$17|$18|$19|$20"
# Stands before a date whose parts are in order.
IN_ORDER = "\x01"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
# Fixed value: two-digit years below this one belong to this century.
CENTURY_TURN = 69


def normalise_name(header: str) -> str:
    """``" Approx Cost (for two) "`` becomes ``approx_cost_for_two``."""
    return re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")


def strip(col: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(col.cast("string"), F.lit(WHITE_SPACE))


def known_text(trimmed: Column) -> Column:
    """Trimmed text, with spellings of 'missing' turned into NULL."""
    return F.when(~trimmed.isin(*MISSING_AFTER_TRIM), trimmed)


def number_text(col: Column, trimmed: bool = False) -> Column:
    """Trimmed text without thousands separators."""
    return F.replace(col if trimmed else strip(col), F.lit(","), F.lit(""))


# Reading an integer takes five projections, text -> short integer -> spelled part -> number and digits -> value. Each
# step refers to plain columns of those before, which keeps the generated code small enough to be compiled.


def short_integer(text: Column) -> Column:
    """The digits of a short integer, empty for a cell that takes a closer look."""
    return F.regexp_extract(text, SHORT_INTEGER, 1)


def spelled_part(text: Column) -> Column:
    """The number in a prefixed code (``fd123``) or a band (``1K+ ratings``), or empty; no text is both."""
    return F.concat(F.regexp_extract(text, PREFIXED_CODE, 1), F.regexp_extract(text, COUNT_BAND, 1))


def spelled_times(text: Column) -> Column:
    """What the number in a band counts."""
    return F.when(F.regexp_extract(text, COUNT_BAND, 2) != "", F.lit(1000)).otherwise(F.lit(1)).cast("bigint")


def spelled_number(text: Column, part: Column, times: Column) -> Column:
    """The number in a plain spelling, a prefixed code or a band, or NULL."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).when(part != "", part.try_cast("double") * times.cast("double"))


def spelled_digits(text: Column, part: Column) -> Column:
    """The digits and sign of a whole number, or NULL."""
    return (
        F.when(text.rlike(WHOLE_NUMBER), F.regexp_extract(text, WHOLE_NUMBER, 1))
        .when(part.rlike(WHOLE_NUMBER), F.regexp_extract(part, WHOLE_NUMBER, 1))
    )


def integer_value(digits: Column, times: Column, number: Column) -> Column:
    """The integer that was spelled; a number with a fraction is none. Long integers stay exact.

    Digits are cast as they stand; only spellings with an exponent or a fraction of thousands go through
    a double. An integer beyond 64 bits is none.
    """
    return F.when(digits.isNotNull(), F.try_multiply(digits.try_cast("bigint"), times)).when(
        number == F.floor(number), number.try_cast("bigint")
    )


def integer_reading(text: Column, number: Column) -> Column:
    """How an integer was read: plain, prefix, band, nonint (a fraction), lost, or NULL if missing."""
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(number.isNull(), "lost")
        .when(number != F.floor(number), "nonint")
        .when(text.rlike(PLAIN_NUMBER), "plain")
        .when(text.rlike(PREFIXED_CODE), "prefix")
        .otherwise("band")
    )


def number_characters(col: Column) -> Column:
    """Text without anything but digits, dots and minus signs (``₹ 200`` becomes ``200``)."""
    text = col.cast("string")
    return F.when(text.rlike(NUMBER_ALONE), text).otherwise(F.regexp_replace(text, r"[^0-9.\-]+", ""))


def parse_number(characters: Column, as_type: str = "double") -> Column:
    """The number in what ``number_characters`` left over, or NULL (``--``, ``1-2``)."""
    return F.when(characters.rlike(PLAIN_NUMBER), characters.try_cast(as_type))


def date_parts(text: Column) -> Column:
    """The parts of a date with or without a time, as an array: swap, year, month, day, clock, half of the day, offset.

    Five spellings are known: year first, eight digits, day and month in numbers, and a month by name
    before or after the day. A time may have a half of the day; an offset or zone moves it to UTC. ``swap`` is
    filled where day and month may change places; they stand month-first then. NULL for any other text.
    ``text`` should be a trimmed plain column. The result is for a projection of its own, so that both readings
    of a cell share the pattern's work.
    """
    # A separator of one character spares the compilation of a pattern for every cell.
    found = F.split(F.regexp_replace(text, ANY_DATE, f"{IN_ORDER}|{ANY_ORDER}"), r"\|")
    return F.when((F.size(found) == 10) & (found[0] == IN_ORDER) & ~text.startswith(IN_ORDER), F.slice(found, 2, 9))


def may_swap(parts: Column) -> Column:
    """Whether day and month of a date may change places."""
    return parts[0] != ""


def timestamp_of(parts: Column, day_first: bool) -> Column:
    """The timestamp of ``date_parts``, or NULL where no such day exists; a cast rejects it without raising per row."""
    month, day = parts[2], parts[3]
    if day_first:
        swap = may_swap(parts)
        month, day = F.when(swap, parts[3]).otherwise(parts[2]), F.when(swap, parts[2]).otherwise(parts[3])
    return _from_parts([parts[1], month, day, *[parts[i] for i in range(4, 9)]])


def preferred_timestamp(parts: Column, day_first: bool) -> Column:
    """A column's preferred reading; a cell that it makes impossible (month 25) is read the other way."""
    return F.coalesce(timestamp_of(parts, day_first), F.when(may_swap(parts), timestamp_of(parts, not day_first)))


def _from_parts(parts: Sequence[Column]) -> Column:
    """The timestamp of year, month, day, hour, minute, second, half of the day and offset, all as text."""
    year, month, day, hour, minute, second, half, zone = parts
    century = F.when(year.try_cast("int") < CENTURY_TURN, F.lit("20")).otherwise(F.lit("19"))
    year = F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)
    place = F.position(F.initcap(F.substring(month, 1, 3)), F.lit(MONTHS))
    named = F.when(place % 3 == 1, F.floor((place + 2) / 3).cast("string"))
    month = F.when(month >= "A", named).otherwise(month)
    number = hour.try_cast("int") % 12
    hours = F.when(half == "", hour).otherwise(F.when(F.lower(half) == "pm", number + 12).otherwise(number).cast("string"))
    seconds = F.when(second == "", F.lit("00")).otherwise(second)
    clock = F.when(hour != "", F.concat_ws(":", hours, minute, seconds)).otherwise(F.lit("00:00:00"))
    # A cast raises and catches an error for month 13 or day 32, which the other reading of a date is full of.
    fits = ((F.length(month) < 2) | (month <= "12")) & ((F.length(day) < 2) | (day <= "31"))
    local = F.when(fits, F.concat(F.concat_ws("-", year, month, day), F.lit(" "), clock).try_cast("timestamp_ntz"))
    offset = F.replace(zone, F.lit(":"), F.lit(""))
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 4, 2).try_cast("int")
    behind = F.when(offset.startswith("-"), minutes).when(offset.startswith("+"), -minutes).otherwise(F.lit(0))
    return F.when(zone == "", local).otherwise(F.timestamp_add("MINUTE", behind, local))


def split_tags(col: Column) -> Column:
    """Tags of a comma separated list, trimmed; a list that is empty or missing has none."""
    return F.when(
        col.isNotNull() & (col != ""), F.transform(F.split(col, ","), lambda tag: F.trim(tag))
    )


def shorten(col: Column, limit: int = 25) -> Column:
    """Cut long values for a preview, marking the cut."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit - 3), F.lit("..."))).otherwise(col)


def join_sorted(items: Column, separator: str = " + ") -> Column:
    return F.array_join(F.array_sort(items), separator)


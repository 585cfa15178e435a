"""Date expressions: deadlines as people write them, mail dates, base64 bodies.

Everything is built-in expressions.  A deadline is first matched against the
anchored layouts that publishers use, which decide by themselves where day,
month and year stand, so each value is parsed once.  What fits none is read
leniently: times, zones, weekdays and small words are dropped, and a date is
put together from the month's name and the numbers that are left.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlake.functions.text import col_

# --- fixed values -----------------------------------------------------------
# English month names, whole or cut to three letters (September also to four).
MONTH_NAME = (r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|"
              r"oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
MONTH_LETTERS = "janfebmaraprmayjunjulaugsepoctnovdec"
WEEKDAY_NAME = r"(?:mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:r(?:s(?:day)?)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)"
CLOCK = r"\b\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[ap]m)?\b|\b\d{1,2}\s*[ap]m\b"
ZONE = r"\b(?:utc|gmt|z)\b(?:\s*[+-]\d{1,2}(?::?\d{2})?)?"
# Words and signs that carry no part of a date.
FILLER = r"\b(?:at|on|and|of|ad)\b|[,;.'/-]"
# ---------------------------------------------------------------------------


def _month(name: Column) -> Column:
    """Number of a month from its name."""
    return ((F.instr(F.lit(MONTH_LETTERS), F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("int").cast("string")


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day)


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), lambda x: then(x)), 1)


def _layout(s: Column) -> Column:
    """The value as ``year-month-day`` if it has one of the publishers' layouts, else null.

    After a leading year the day comes first wherever the last number can be a month.
    """
    month_first, day_first = rf"(?i)^({MONTH_NAME}) (\d{{1,2}}), (\d{{4}})$", rf"(?i)^(\d{{1,2}}) ({MONTH_NAME}),? (\d{{4}})$"
    numbers, iso = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})$", r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
    part = lambda pattern, i: F.regexp_extract(s, pattern, i)
    return (
        F.when(s.rlike(iso), F.when(part(iso, 3).cast("int") <= 12, _ymd(part(iso, 1), part(iso, 3), part(iso, 2))).otherwise(s))
        .when(s.rlike(numbers), F.when(part(numbers, 3).cast("int") <= 12, _ymd(part(numbers, 4), part(numbers, 3), part(numbers, 1)))
              .otherwise(_ymd(part(numbers, 4), part(numbers, 1), part(numbers, 3))))
        .when(s.rlike(day_first), _ymd(part(day_first, 3), _month(part(day_first, 2)), part(day_first, 1)))
        .when(s.rlike(month_first), _ymd(part(month_first, 3), _month(part(month_first, 1)), part(month_first, 2))))


def _lenient(s: Column, run_date: str) -> Column:
    """``year-month-day`` from a value in free form, day before month where both could be meant, else null.

    A missing day, month or year is the run date's (a day past the month's end
    becomes its last); a two-digit year is the one within fifty years of the
    run; eight digits are year, and two parts.  A value with words that say nothing of
    a date, or with more numbers than a date has, is no date.
    """
    run_year, _, run_day = run_date.split("-")

    def full_year(y: Column) -> Column:
        short = F.lit(int(run_year) // 100 * 100) + y.cast("int")
        near = F.when(short >= int(run_year) + 50, short - 100).when(short < int(run_year) - 50, short + 100).otherwise(short)
        return F.when(F.length(y) <= 2, near.cast("string")).otherwise(F.lpad(y, 4, "0"))

    def is_year(c: Column) -> Column:
        return (F.length(c) > 2) | (c.cast("int") > 31)

    def month_of(y: Column, m: Column) -> Column:
        last = F.dayofmonth(F.last_day(F.try_to_date(_ymd(y, m, F.lit("1")), "yyyy-M-d")))
        return _ymd(y, m, F.least(F.lit(int(run_day)), last).cast("string"))

    def dated(p: Column) -> Column:
        """From the month's number (null if none is named) and the numbers that are left."""
        month, n = p["month"], F.size(p["numbers"])
        one, two, three = (F.try_element_at(p["numbers"], F.lit(i)) for i in (1, 2, 3))
        by_name = (
            F.when(n == 0, month_of(F.lit(run_year), month))
            .when((n == 1) & is_year(one), month_of(full_year(one), month))
            .when(n == 1, _ymd(F.lit(run_year), month, one))
            .when((n == 2) & is_year(one), _ymd(full_year(one), month, two))
            .when(n == 2, _ymd(full_year(two), month, one)))
        second, third = two.cast("int"), three.cast("int")
        by_number = (
            F.when((n == 3) & (F.length(one) > 2), F.when(third <= 12, _ymd(one, three, two)).otherwise(_ymd(one, two, three)))
            .when(n == 3, F.when(second > 12, _ymd(full_year(three), one, two)).otherwise(_ymd(full_year(three), two, one)))
            .when((n == 2) & ~is_year(one) & ~is_year(two), F.when(second > 12, _ymd(F.lit(run_year), one, two)).otherwise(_ymd(F.lit(run_year), two, one))))
        return F.when(month.isNotNull(), by_name).otherwise(by_number)

    def parts(text: Column) -> Column:
        named = F.regexp_extract(text, rf"\b({MONTH_NAME})\b", 1)
        bare = F.regexp_replace(text, rf"\b{MONTH_NAME}\b|\b{WEEKDAY_NAME}\b", " ")
        bare = F.trim(F.regexp_replace(F.regexp_replace(bare, r"(\d)(?:st|nd|rd|th)\b", "$1"), FILLER, " "))
        numbers = _let(bare, lambda x: F.when(x == "", F.array().cast("array<string>")).when(x.rlike(r"^(?:\d{1,4}(?:\s+|$)){1,3}$"), F.split(x, r"\s+")))
        return F.struct(F.when(named != "", _month(named)).alias("month"), numbers.alias("numbers"))

    compact = r"^\s*(\d{4})(\d{2})(\d{2})\s*$"
    text = F.regexp_replace(F.lower(s), f"{CLOCK}|{ZONE}", " ")
    run_together = F.struct(F.lit(None).cast("string").alias("month"), F.array(*[F.regexp_extract(s, compact, i) for i in (1, 2, 3)]).alias("numbers"))
    return _let(F.when(s.rlike(compact), run_together).otherwise(_let(text, parts)), lambda p: F.when(p["numbers"].isNotNull(), dated(p)))


def deadline_iso(c: Column | str, run_date: str, lenient: bool = True) -> Column:
    """Day-first deadline -> ``yyyy-MM-dd``; '' when it is blank or no date."""
    s = F.coalesce(col_(c), F.lit(""))
    spelled = F.coalesce(_layout(s), _lenient(s, run_date)) if lenient else _layout(s)
    return F.when(s == "", F.lit("")).otherwise(F.coalesce(F.date_format(F.try_to_date(spelled, "yyyy-M-d"), "yyyy-MM-dd"), F.lit("")))


def deadline_fallback(publisher_iso: Column | str, deadline_text: Column | str, run_date: str,
                      lenient: bool = True) -> Column:
    """Publisher's ISO date when non-blank, else the parsed text."""
    return F.coalesce(F.nullif(col_(publisher_iso), F.lit("")), deadline_iso(deadline_text, run_date, lenient))


def mail_date(date_header: Column | str) -> Column:
    """RFC-2822 ``Date`` header -> calendar date in the sender's own offset.

    Day, month name and year (two-digit years as in RFC 2822: below 69 in this
    century) are read as written, whatever blanks or hyphens lie between (no
    UTC shift); '' when absent.
    """
    text = F.coalesce(col_(date_header), F.lit(""))
    layout = r"(\d{1,2})[\s-]+([A-Za-z]{3})[a-z]*[\s-]+(\d{4}|\d{2})\b"
    day, month, year = (F.regexp_extract(text, layout, i) for i in (1, 2, 3))
    century = F.when(F.length(year) == 4, F.lit("")).when(year < "69", F.lit("20")).otherwise(F.lit("19"))
    spelled = F.concat_ws(" ", day, F.initcap(month), F.concat(century, year))
    return F.coalesce(F.date_format(F.try_to_date(spelled, "d MMM yyyy"), "yyyy-MM-dd"), F.lit(""))


def base64url_text(body: Column | str) -> Column:
    """URL-safe base64 (padding optional) -> UTF-8 text, bad bytes replaced."""
    std = F.translate(F.coalesce(col_(body), F.lit("")), "-_", "+/")
    return F.make_valid_utf8(F.unbase64(std).cast("string"))

"""Text to typed values, as Column expressions. Unparseable text is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date of three texts; NULL unless they name a real day."""
    parts = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(parts, "yyyy-MM-dd"))


def number(text: Column) -> Column:
    """Whatever digits and points are left of a text, as double."""
    return F.nullif(F.regexp_replace(text, "[^0-9.]", ""), F.lit("")).try_cast("double")


def first_integer(text: Column) -> Column:
    """The first run of digits: '1.234 reviews' is 1."""
    return _group(text, r"(\d+)", 1).try_cast("long")


def decimal_comma(text: Column) -> Column:
    return F.regexp_replace(text, ",", ".").try_cast("double")


def compact_number(text: Column) -> Column:
    """'1234', '36.6K' and '1.5M' as long; other forms are NULL. Decimal arithmetic, so 32.3K is 32300."""
    t = F.trim(text)
    scaled = lambda unit, factor: (F.when(t.rlike(rf"^[\d.]+{unit}$"), F.regexp_replace(t, f"{unit}$", "").try_cast("decimal(18,6)") * factor)).cast("long")
    return F.coalesce(F.when(t.rlike(r"^\d+$"), t.try_cast("long")), scaled("K", 1000), scaled("M", 1_000_000))


def long_form_date(text: Column) -> Column:
    """'ngày D tháng M năm YYYY' anywhere in the text."""
    pattern = r"ngày (\d{1,2}) tháng (\d{1,2}) năm (\d{4})"
    return _date(_group(text, pattern, 3), _group(text, pattern, 2), _group(text, pattern, 1))


def month_year_date(text: Column) -> Column:
    """'tháng 10/2024', 'Tháng: 9 2023': the first of that month."""
    rest = F.regexp_replace(F.lower(text), r"tháng[:\s]*", "")
    return _date(_group(rest, r"(\d{4})", 1), _group(rest, r"(\d{1,2})(?=/|\s|$)", 1), F.lit("1"))


DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "d.M.yyyy", "yyyyMMdd")


def multi_format_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The first format that fits; month before day where both do."""
    return F.coalesce(*(F.try_to_date(F.trim(text), f) for f in formats))


def relative_date(text: Column, seen: Column) -> Column:
    """Absolute 'd-M-yyyy' or 'yyyy-M-d', or 'N ngày/tuần/tháng/giờ/phút trước' before the timestamp seen, or 'vừa xong'."""
    t = F.trim(text)
    n = first_integer(t).cast("int")
    unit = lambda word: t.rlike(rf"^\d+ {word}")
    back = lambda seconds: F.timestamp_seconds(F.unix_timestamp(seen) - n * seconds).cast("date")
    absolute = F.coalesce(F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(t, "d-M-yyyy")), F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d")))
    return (
        F.when(absolute.isNotNull(), absolute)
        .when(unit("ngày"), F.date_sub(seen.cast("date"), n))
        .when(unit("tuần"), F.date_sub(seen.cast("date"), n * 7))
        .when(unit("tháng"), F.add_months(seen.cast("date"), -n))
        .when(unit("giờ"), back(3600))
        .when(unit("phút"), back(60))
        .when(t == "vừa xong", seen.cast("date"))
    )


def js_timestamp(text: Column) -> Column:
    """'Sat Sep 27 2025 00:52:04 GMT+0700 (…)' by its wall clock; the weekday and the zone are dropped."""
    wall = F.regexp_replace(F.regexp_replace(text, r" GMT[+-]\d{4}.*$", ""), r"^[A-Za-z]{3} ", "")
    return F.try_to_timestamp(wall, F.lit("MMM dd yyyy HH:mm:ss"))


def scrape_timestamp(text: Column) -> Column:
    """'yyyy-MM-ddTHH-mm-ss'."""
    return F.try_to_timestamp(F.regexp_replace(text, "T", " "), F.lit("yyyy-MM-dd HH-mm-ss"))


def text_flag(text: Column) -> Column:
    """0/1/true/false in any case as boolean, else NULL."""
    t = F.lower(F.trim(text))
    return F.when(t.isin("1", "true"), True).when(t.isin("0", "false"), False)


def yes_no(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t == "yes", True).when(t == "no", False)


def yes_no_level(text: Column) -> Column:
    """2 for yes, 1 for no."""
    t = F.lower(F.trim(text))
    return F.when(t == "yes", 2).when(t == "no", 1)


def digits_only(text: Column) -> Column:
    return F.when(text.rlike(r"^\d+$"), text.try_cast("long"))


def shift_month(year_month: Column, months: int | Column) -> Column:
    """YYYYMM moved by months."""
    total = F.floor(year_month / 100) * 12 + year_month % 100 + months - 1
    return (F.floor(total / 12) * 100 + total % 12 + 1).cast("int")


def days_in_month(year_month: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(F.floor(year_month / 100).cast("int"), (year_month % 100).cast("int"), F.lit(1))))

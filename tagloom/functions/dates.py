"""Date and time columns.  Nothing here reads the wall clock: ``as_of`` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First day of the later sign in each month, January first, and the sign names
# from Capricorn round to Capricorn again.
SIGN_CHANGE_DAYS = (20, 19, 21, 21, 21, 22, 23, 23, 23, 23, 22, 22)
SIGNS = (
    "魔羯座", "水瓶座", "双鱼座", "牡羊座", "金牛座", "双子座", "巨蟹座",
    "狮子座", "处女座", "天秤座", "天蝎座", "射手座", "魔羯座",
)

# Fixed value: day 0 of the day-number functions.
DAY_ZERO = "1900-02-01"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_digits(value) -> Column:
    """``1982-01-11`` (text or date) as the integer 19820111; NULL for any other text."""
    return F.regexp_replace(_col(value).cast("string"), "-", "").try_cast("int")


def days_since(value, as_of: Column, moved_back: int = 0) -> Column:
    """Whole days from a date, timestamp or ``yyyy-MM-dd…`` text to ``as_of`` less a shift; NULL for any other text."""
    until = F.date_sub(as_of, moved_back) if moved_back else as_of
    return F.datediff(until, _col(value).try_cast("date"))


def epoch_to_text(seconds, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.from_unixtime(_col(seconds), fmt)


def text_to_epoch(text, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.unix_timestamp(_col(text), fmt)


def millis_to_timestamp(millis) -> Column:
    return F.timestamp_millis(_col(millis))


def timestamp_to_millis(value) -> Column:
    return F.unix_millis(_col(value).cast("timestamp"))


def shift(value, unit: str, amount) -> Column:
    """Move a date by days, weeks, months or years."""
    value = _col(value)
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    if unit == "day":
        return F.date_add(value, amount)
    if unit == "week":
        return F.date_add(value, amount * 7)
    if unit == "month":
        return F.add_months(value, amount)
    if unit == "year":
        return F.add_months(value, amount * 12)
    raise ValueError(f"unknown unit {unit!r}")


def years_between(later, earlier) -> Column:
    """Difference of the calendar years."""
    return F.year(_col(later)) - F.year(_col(earlier))


def seconds_between(later, earlier) -> Column:
    return F.timestamp_diff("SECOND", _col(earlier), _col(later))


def first_of_month(value) -> Column:
    return F.trunc(_col(value), "MM")


def last_of_month(value) -> Column:
    return F.last_day(_col(value))


def days_in_month(value) -> Column:
    return F.dayofmonth(F.last_day(_col(value)))


def days_in_year(value) -> Column:
    return F.dayofyear(F.make_date(F.year(_col(value)), F.lit(12), F.lit(31)))


def day_number(value) -> Column:
    """Days since ``DAY_ZERO``."""
    return F.datediff(_col(value), F.lit(DAY_ZERO).cast("date"))


def day_from_number(number) -> Column:
    return F.date_add(F.lit(DAY_ZERO).cast("date"), _col(number).cast("int"))


def zodiac(value) -> Column:
    """Sign of the zodiac of a date."""
    value = _col(value)
    month, day = F.month(value), F.dayofmonth(value)
    change = F.element_at(F.array(*[F.lit(d) for d in SIGN_CHANGE_DAYS]), month)
    names = F.array(*[F.lit(s) for s in SIGNS])
    return F.element_at(names, F.when(day < change, month).otherwise(month + 1))


def is_date(text) -> Column:
    """Whether text is ``yyyy-M-d`` or ``yyyyMMdd`` and names a day that exists."""
    text = _col(text)
    shape = r"^([0-9]{4})-?(0?[1-9]|1[0-2])-?(0?[1-9]|[12][0-9]|3[01])\z"
    part = [F.regexp_extract(text, shape, i).try_cast("int") for i in (1, 2, 3)]
    month_start = F.make_date(F.greatest(part[0], F.lit(1)), part[1], F.lit(1))
    fits = F.when(text.rlike(shape), part[2] <= F.dayofmonth(F.last_day(month_start)))
    return F.coalesce(fits, F.lit(False))

"""Calendar and date expressions, all inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Holidays of each month by the default calendar, months of high season, and the intensity of each month.
HOLIDAYS = {1: 2, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1, 7: 1, 8: 0, 9: 1, 10: 1, 11: 2, 12: 1}
HIGH_SEASON = (3, 9, 12)
INTENSITY = {1: 0.92, 2: 0.95, 3: 1.12, 4: 0.98, 5: 0.96, 6: 1.05, 7: 0.97, 8: 0.98, 9: 1.15, 10: 1.0, 11: 0.95, 12: 1.18}

WEEK_DAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def by_month(values: dict[int, float], date: Column) -> Column:
    """The value of the date's month."""
    return F.when(date.isNotNull(), F.element_at(F.array(*(F.lit(values[m]) for m in range(1, 13))), F.month(date)))


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM").cast("date")


def quarter_end(date: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(date, "QUARTER"), 2))


def week_start(date: Column, first: str = "Mon") -> Column:
    """First day of the date's week; an unknown name of a day means Monday."""
    k = WEEK_DAYS.index(first.upper()) if first.upper() in WEEK_DAYS else 0
    return F.date_sub(date, F.pmod(F.weekday(date) - F.lit(k), F.lit(7)))


def business_days(date: Column) -> Column:
    """Mondays to Fridays of the date's month: twenty in four weeks, and those among the days beyond."""
    first, length = F.weekday(F.trunc(date, "MM")), F.day(F.last_day(date))
    extra = [F.when((length > 28 + i) & (F.pmod(first + i, F.lit(7)) < 5), 1).otherwise(0) for i in range(3)]
    return F.when(date.isNotNull(), F.lit(20) + extra[0] + extra[1] + extra[2])


def year_period(code: Column, strict: bool = False) -> Column:
    """Date of a fiscal code: YYYYMMDD, YYYY/PP or YYYY-PP, YYYYPPP, YYYYMM (an extension), or any ISO date.

    Periods are months 1 to 12. What can't be read is null, or an error where ``strict``.
    """
    s = F.trim(code.cast("string"))
    first = lambda y, p: F.when(p.between(1, 12), F.make_date(y, p, F.lit(1)))
    number = lambda pattern, i: F.regexp_extract(s, pattern, i).try_cast("int")
    day = F.when(s.rlike(r"^\d{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date"))
    parted = r"^\s*(\d{1,4})\s*[/-]\s*(\d{1,3})\s*$"
    date = F.coalesce(
        day,
        F.when(s.rlike(parted), first(number(parted, 1), number(parted, 2))),
        F.when(s.rlike(r"^\d{7}$"), first(F.substring(s, 1, 4).try_cast("int"), F.substring(s, 5, 3).try_cast("int"))),
        F.when(s.rlike(r"^\d{6}$"), first(F.substring(s, 1, 4).try_cast("int"), F.substring(s, 5, 2).try_cast("int"))),
        F.when(~s.rlike(r"^\d+$"), s.try_cast("date")),
    )
    return F.when(
        code.isNotNull() & date.isNull(), F.raise_error(F.concat(F.lit("not a year and period: "), s)).cast("date"),
    ).otherwise(date) if strict else date


def federal_holidays(date: Column) -> Column:
    """Federal holidays of the United States in the date's month, with the days on which they are observed.

    New Year, Juneteenth (from 2021), Independence Day, Veterans Day and Christmas have a date; one that falls on a
    Saturday is observed on the day before as well, one on a Sunday on the day after. The six others are Mondays and a
    Thursday: Martin Luther King's from 1986, Washington's Birthday, Memorial Day, Labor Day, Columbus Day, Thanksgiving.
    """
    m, y = F.month(date), F.year(date)
    day = lambda month, d, year=y: F.weekday(F.make_date(year, F.lit(month), F.lit(d)))
    count = F.when(m.isin(2, 5, 9, 10, 11) | ((m == 1) & (y >= 1986)), 1).otherwise(0)
    for month, d, since in ((1, 1, 1), (6, 19, 2021), (7, 4, 1), (11, 11, 1), (12, 25, 1)):
        observed = F.when(day(month, d) == 6, 1).when((day(month, d) == 5) & F.lit(month != 1), 1).otherwise(0)
        count = count + F.when((m == month) & (y >= since), 1 + observed).otherwise(0)
    return F.when(date.isNotNull(), count + F.when((m == 12) & (day(1, 1, y + 1) == 5), 1).otherwise(0))


def calendar(name: str, holidays: dict[int, int] | str | None = None) -> dict[str, Column]:
    """The 16 calendar columns of the date column ``name``."""
    d = F.col(f"`{name}`").cast("date")
    m = F.month(d)
    flag = lambda c: c.cast("int")
    free = federal_holidays(d) if holidays == "federal" else by_month(holidays or HOLIDAYS, d)
    to_quarter = F.datediff(quarter_end(d), d)
    return {
        f"{name}_business_days": business_days(d),
        f"{name}_days_in_month": F.day(F.last_day(d)),
        f"{name}_holidays": free,
        f"{name}_net_working_days": F.when(d.isNotNull(), F.greatest(business_days(d) - free, F.lit(1))),
        f"{name}_month_in_quarter": (m - 1) % 3 + 1,
        f"{name}_is_quarter_end": flag(d == quarter_end(d)),
        f"{name}_is_quarter_start": flag(d == F.trunc(d, "QUARTER")),
        f"{name}_is_year_end": flag(m == 12),
        f"{name}_is_year_start": flag(m == 1),
        f"{name}_is_high_season": flag(m.isin(*HIGH_SEASON)),
        f"{name}_seasonal_intensity": by_month(INTENSITY, d),
        f"{name}_is_q3_close": flag(m == 9),
        f"{name}_is_q1_close": flag(m == 3),
        f"{name}_days_to_quarter_end": to_quarter,
        f"{name}_days_to_year_end": F.datediff(F.make_date(F.year(d), F.lit(12), F.lit(31)), d),
        f"{name}_quarter_end_urgency": F.when(d.isNotNull(), F.least(1.0 / (to_quarter + 1), F.lit(1.0))),
    }


def seasonal(name: str, features: list[str] | tuple[str, ...] = ("month", "quarter", "year")) -> dict[str, Column]:
    """Seasonal columns of the date column ``name`` with their places on the circle."""
    d = F.col(f"`{name}`").cast("date")
    circle = lambda x, n: (F.sin(2 * F.pi() * x / n), F.cos(2 * F.pi() * x / n))
    out: dict[str, Column] = {}
    for feature, short, value, n in (
        ("month", "month", F.month(d), 12), ("quarter", "quarter", F.quarter(d), 4), ("year", "", F.year(d), 0),
        ("day_of_week", "dow", F.weekday(d), 7), ("day_of_month", "", F.day(d), 0),
        ("week_of_year", "", F.weekofyear(d), 0),
    ):
        if feature in features:
            out[f"{name}_{feature}"] = value
            if n:
                out[f"{name}_{short}_sin"], out[f"{name}_{short}_cos"] = circle(value, n)
    return out

"""Column expressions on HHMM clock values, dates, places and labels. All run inside Spark's code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_MINUTES = 1440

# Hour ranges and slot names of the two time-of-day groupings.
HOUR_BUCKETS = [(5, 10, "morning"), (10, 15, "midday"), (15, 20, "evening")]
OTHER_HOURS = "late_night"
TIME_SLOTS = [(360, "Early Morning"), (720, "Morning"), (1080, "Afternoon"), (1440, "Evening")]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hhmm_to_minutes(c: str | Column) -> Column:
    """Clock value 1345 -> 825 minutes after midnight; keeps fractions of a filled mean."""
    c = as_column(c)
    return F.floor(c / 100) * 60 + c % 100


def hour_of_hhmm(c: str | Column) -> Column:
    return F.floor(as_column(c) / 100).cast("int")


def minute_of_hhmm(c: str | Column) -> Column:
    return as_column(c) % 100


def cyclical(c: Column, period: Column | float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of the given period."""
    angle = c * (2 * F.pi()) / period
    return F.sin(angle), F.cos(angle)


def time_of_day(hour: str | Column) -> Column:
    hour = as_column(hour)
    choice = None
    for low, high, name in HOUR_BUCKETS:
        test = (hour >= low) & (hour < high)
        choice = F.when(test, name) if choice is None else choice.when(test, name)
    return choice.otherwise(OTHER_HOURS)


def time_slot(minutes: str | Column) -> Column:
    """Six-hour slots closed on the right, the first one also on the left; outside the day -> NULL."""
    minutes = as_column(minutes)
    choice = F.when(minutes < 0, F.lit(None).cast("string"))
    for upper, name in TIME_SLOTS:
        choice = choice.when(minutes <= upper, name)
    return choice


def parse_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; unreadable text -> NULL."""
    return F.to_date(F.try_to_timestamp(as_column(c), F.lit(fmt)))


def weekday(c: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(as_column(c))


def is_weekend(c: str | Column) -> Column:
    return F.weekday(as_column(c)) >= 5


def day_name(c: str | Column) -> Column:
    return F.date_format(as_column(c), "EEEE")


def month_start(year: str | Column, month: str | Column) -> Column:
    return F.make_date(as_column(year), as_column(month), F.lit(1))


def city_part(c: str | Column) -> Column:
    """Text before the first comma, trimmed."""
    return F.trim(F.split(as_column(c), ",", 2)[0])


def state_part(c: str | Column) -> Column:
    """Text after the first comma, trimmed; NULL without a comma."""
    return F.trim(F.get(F.split(as_column(c), ",", 2), F.lit(1)))


def cause_label(c: str | Column, prefix: str = "DELAY_DUE_") -> Column:
    return F.initcap(F.replace(F.replace(as_column(c), F.lit(prefix), F.lit("")), F.lit("_"), F.lit(" ")))


def clip_upper(c: str | Column, limit: float) -> Column:
    """Cap at ``limit`` and keep NULL (``least`` would turn NULL into the limit)."""
    c = as_column(c)
    return F.when(c > limit, F.lit(float(limit))).otherwise(c)


def over_threshold(c: str | Column, op: str = ">", threshold: float = 15.0, null_as: int = 0) -> Column:
    """Binary label ``c op threshold``; a NULL measure gets ``null_as``."""
    c = as_column(c)
    tests = {">": c > threshold, ">=": c >= threshold, "<": c < threshold, "<=": c <= threshold}
    return F.when(c.isNull(), int(null_as)).when(tests[op], 1).otherwise(0)

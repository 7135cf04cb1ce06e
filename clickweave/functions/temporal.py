"""Time functions (F3, F10-F16) as Column expressions.

Every function that the reference evaluates against wall-clock "now" takes
an explicit ``as_of`` Column instead: ``current_timestamp()`` in streaming,
a literal or ``max(ts)`` scalar subquery in batch. That keeps results
reproducible and lets a literal ``as_of`` reach the Parquet scan as a
pushed-down, partition-pruning filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
SECONDS_PER_DAY = 86_400


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_from_birthdate(birthdate, as_of) -> Column:
    """whole years between a 'YYYY-MM-DD' birth date and ``as_of``.

    Year difference minus one when (month, day) of ``as_of`` precedes the
    birthday's. Not ``months_between``: born 2000-02-29, on 2023-02-28 this
    gives 22. Null in, null out; a malformed date raises (ANSI ``to_date``).
    """
    b = F.to_date(_c(birthdate), "yyyy-MM-dd")
    n = F.to_date(_c(as_of))
    before = (F.month(n) * 100 + F.dayofmonth(n)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(n) - F.year(b) - before.cast("int")).cast("int")


def timestamp_from_nanos(col) -> Column:
    """ns epoch long -> timestamp (Spark keeps microseconds)."""
    ns = _c(col)
    # exact floor division on longs (a double would lose the last digits)
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000)))


def timestamp_from_seconds(col) -> Column:
    """s epoch long -> timestamp."""
    return F.timestamp_seconds(_c(col))


def format_datetime(ts) -> Column:
    """``%Y-%m-%d %H:%M:%S``."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def time_literal(value, dtype: str) -> Column:
    """A literal of a collected time. TIMESTAMP_NTZ is written as text: a naive datetime
    given to ``F.lit`` would be read in the driver's local zone."""
    if value is None:
        return F.lit(None).cast(dtype)
    if dtype == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")
    return F.lit(value).cast(dtype)


def floor_minute(ts) -> Column:
    """F13."""
    return F.date_trunc("minute", _c(ts))


def floor_hour(ts) -> Column:
    """F13."""
    return F.date_trunc("hour", _c(ts))


def seconds_between(a, b) -> Column:
    """``(b - a).total_seconds()`` as a double."""
    return (F.unix_micros(_c(b).cast("timestamp")) - F.unix_micros(_c(a).cast("timestamp"))) / MICROS_PER_SECOND


def relative_time(ts, as_of) -> Column:
    """human relative time of ``ts`` seen from ``as_of``.

    Follows the public rules of the "natural time" helper the reference uses:
    whole seconds of the absolute difference choose the wording; days
    switch to day/month/year wording; ``ago`` for the past, ``from now``
    for the future; under one second is ``now``.
    """
    diff = F.unix_micros(_c(as_of).cast("timestamp")) - F.unix_micros(_c(ts).cast("timestamp"))
    total = F.abs(diff)
    days = F.floor(total / (SECONDS_PER_DAY * MICROS_PER_SECOND)).cast("long")
    secs = F.floor((total % (SECONDS_PER_DAY * MICROS_PER_SECOND)) / MICROS_PER_SECOND).cast("long")
    years = F.floor(days / 365).cast("long")
    d = days % 365
    months = F.floor(d / 30.5).cast("long")

    def n(fmt, v):
        return F.format_string(fmt, v)

    phrase = (
        F.when((years == 0) & (d < 1),
               F.when(secs == 0, F.lit(None))
               .when(secs == 1, F.lit("a second"))
               .when(secs < 60, n("%d seconds", secs))
               .when(secs < 120, F.lit("a minute"))
               .when(secs < 3600, n("%d minutes", F.floor(secs / 60).cast("long")))
               .when(secs < 7200, F.lit("an hour"))
               .otherwise(n("%d hours", F.floor(secs / 3600).cast("long"))))
        .when(years == 0,
              F.when(d == 1, F.lit("a day"))
              .when(months == 0, n("%d days", d))
              .when(months == 1, F.lit("a month"))
              .otherwise(n("%d months", months)))
        .when(years == 1,
              F.when((months == 0) & (d == 0), F.lit("a year"))
              .when(months == 0, F.when(d == 1, F.lit("1 year, 1 day")).otherwise(n("1 year, %d days", d)))
              .when(months == 1, F.lit("1 year, 1 month"))
              .otherwise(n("1 year, %d months", months)))
        .otherwise(n("%d years", years))
    )
    return F.when(_c(ts).isNull() | _c(as_of).isNull(), F.lit(None)).when(
        phrase.isNull(), F.lit("now")).when(
        diff < 0, F.concat(phrase, F.lit(" from now"))).otherwise(F.concat(phrase, F.lit(" ago")))


def time_axis(end, periods: int, step: str) -> Column:
    """``periods`` evenly spaced points ending at ``end`` (array column).

    ``step`` is a day-time interval text such as ``"1 minute"`` or
    ``"30 minutes"``.
    """
    e = _c(end)
    back = F.make_dt_interval(secs=F.lit((periods - 1) * step_seconds(step)))
    return F.sequence(e - back, e, F.make_dt_interval(secs=F.lit(step_seconds(step))))


def step_seconds(step: str) -> int:
    """Seconds in an interval text like ``"30 minutes"`` or ``"8 hours 30 minutes"``."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    words = step.split()
    if len(words) % 2:
        raise ValueError(f"bad interval text: {step!r}")
    return sum(int(n) * units[u.lower().rstrip("s")] for n, u in zip(words[::2], words[1::2]))

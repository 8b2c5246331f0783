"""Date requests, refresh windows and partition values as Column expressions.

Every function takes and returns Columns, so the same definition plans a single
load (a one-row DataFrame) or a whole table of backfill requests and schedules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablekeel.spec import STRATEGIES

# Fixed value: the text shape of a day (year 0000 is no calendar year).
DAY_SHAPE = r"\A(?!0000)\d{4}-\d{2}-\d{2}\z"
# White space trimmed from the two parts of a range.
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


def is_given(target_date: Column) -> Column:
    """A NULL or empty request is none at all; the strategy's default applies."""
    return F.coalesce(target_date, F.lit("")) != ""


def parse_period(partition_type: Column, text: Column) -> Column:
    """First day of the day ``YYYY-MM-DD`` or month ``YYYY-MM`` that ``text`` names.

    NULL when the shape is wrong for the partition type or there is no such day.
    """
    day_text = F.concat(text, F.when(partition_type == "month", "-01").otherwise(""))
    return F.when(day_text.rlike(DAY_SHAPE), day_text.try_cast("date"))


def period_end(partition_type: Column, first_day: Column) -> Column:
    """Last day of the day or month that starts on ``first_day``."""
    return F.when(partition_type == "month", F.last_day(first_day)).otherwise(first_day)


def request_parts(target_date: Column) -> Column:
    """A request split at its commas: one part for a single period, two for a range."""
    return F.split(target_date, ",", -1)


def request_part(target_date: Column, parts: Column, position: int) -> Column:
    """Start (0) or end (1) text of a request.

    A single period stands for both and must be written exactly; the parts of a range
    may have white space around them.
    """
    part = F.trim(F.get(parts, F.lit(position)), F.lit(WHITE_SPACE))
    return F.when(F.size(parts) == 1, target_date).otherwise(part)


def request_error(
    partition_type: Column,
    target_date: Column,
    parts: Column,
    texts: tuple[Column, Column],
    days: tuple[Column, Column],
) -> Column:
    """Why a request is no valid range, or NULL if it is one."""

    def not_a_period(text: Column) -> Column:
        wanted = F.when(partition_type == "day", "YYYY-MM-DD").otherwise("YYYY-MM")
        return F.format_string("'%s' is not a valid %s in the form %s", text, partition_type, wanted)

    return (
        F.when(
            F.coalesce(~partition_type.isin("day", "month"), F.lit(True)),
            F.format_string("target_date needs partition_type day or month, got '%s'", partition_type),
        )
        .when(F.size(parts) > 2, F.format_string("target_date '%s' has more than one comma", target_date))
        .when(days[0].isNull(), not_a_period(texts[0]))
        .when(days[1].isNull(), not_a_period(texts[1]))
        .when(days[0] > days[1], F.format_string("'%s' is after '%s'", *texts))
    )


def strategy_start(strategy: Column, run_date: Column) -> Column:
    """First day a strategy refreshes by default when run on ``run_date``.

    Everything hangs off the day before the run: on the 1st, the "current month" is
    the month that has just ended.
    """
    this_month = F.trunc(strategy_end(run_date), "month")
    return (
        F.when(strategy == "single_day", strategy_end(run_date))
        .when(strategy == "last_and_current_month", F.add_months(this_month, -1))
        .when(strategy == "single_month", this_month)
    )


def strategy_end(run_date: Column) -> Column:
    """Last day any strategy refreshes: the one before the run."""
    return F.date_sub(run_date, 1)


def strategy_error(partition_type: Column, strategy: Column, run_date: Column) -> Column:
    """Why there is no default range, or NULL if there is one."""
    fits = F.lit(False)
    for kind in ("day", "month"):
        fits = fits | ((partition_type == kind) & strategy.isin(*STRATEGIES[kind]))
    return F.when(
        ~F.coalesce(fits, F.lit(False)),
        F.format_string("strategy '%s' gives partition_type '%s' no date range", strategy, partition_type),
    ).when(run_date.isNull(), "run date is NULL")


def day_value(day: Column) -> Column:
    """The partition value ``YYYY-MM-DD`` of a date."""
    return day.cast("string")


def month_value(day: Column) -> Column:
    """The partition value ``YYYY-MM`` of a date."""
    return F.date_format(day, "yyyy-MM")


def window_days(start: Column, end: Column) -> Column:
    """Every day of the window as text: what the source query is filtered by."""
    return F.transform(F.sequence(start, end, F.expr("INTERVAL 1 DAY")), day_value)


def window_months(start: Column, end: Column) -> Column:
    """Every month the window touches as text, in order and without repeats."""
    return F.transform(
        F.sequence(F.trunc(start, "month"), end, F.expr("INTERVAL 1 MONTH")), month_value
    )


def window_partitions(partition_type: Column, start: Column, end: Column) -> Column:
    """The partition values the window covers in the target, by partition type."""
    return F.when(partition_type == "month", window_months(start, end)).otherwise(
        window_days(start, end)
    )

"""Dates and times as the registers write them; unreadable ones become null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraloom.functions.clean import clean_text

DAY_FIRST = ("dd-MM-yyyy", "dd/MM/yyyy", "dd.MM.yyyy")


def day_first(c: Column) -> Column:
    text = clean_text(c)
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in DAY_FIRST), F.try_to_timestamp(text))


def iso_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(clean_text(c))


def epoch_millis(c: Column) -> Column:
    """A time in UTC; 0 and null are none."""
    return F.when(c != 0, F.timestamp_millis(c))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def trailing_year(run_date: Column) -> tuple[Column, Column]:
    """First and last day of the twelve whole months before the run's month."""
    return F.add_months(F.trunc(run_date, "MM"), -12), F.last_day(F.add_months(run_date, -1))


def next_update(c: Column, frequency: Column) -> Column:
    return F.when(frequency == "weekly", c + F.expr("interval 7 days"))


def plan_year(c: Column) -> Column:
    """'YYYY-YYYY' of a file name; a name without it is an error."""
    a, b = (F.regexp_extract(c, r"(\d{4})_(\d{4})", i) for i in (1, 2))
    return F.when(a != "", F.concat_ws("-", a, b)).otherwise(F.raise_error(F.concat(F.lit("no plan year in "), c)))

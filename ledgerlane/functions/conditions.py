"""Predicates shared by the sales jobs. All keep SQL three-valued logic: a NULL test drops the row."""

from __future__ import annotations

from datetime import date, datetime
from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

DateFilter = Literal["year_and_month", "since"]

# Document mode and e-invoicing states.
PRODUCTION = "production"
EMITTED = "Emision"
ACCEPTED = "Valida"


def moment(ts: datetime) -> Column:
    """A zoneless timestamp literal; unlike a literal made from a ``datetime`` it does not depend on any time zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def every(predicates: list[Column]) -> Column:
    """The conjunction of the predicates (TRUE when there are none)."""
    result = F.lit(True)
    for predicate in predicates:
        result = result & predicate
    return result


def in_period(
    date_from: date | None, on: Column, year: Column, month: Column, rule: DateFilter = "year_and_month"
) -> list[Column]:
    """Period tests for an optional start date.

    ``year_and_month`` compares year and month independently (from 2023-06 it keeps no January of any year), which is
    how the reports have always been filtered. ``since`` is a real lower bound; its year test only prunes partitions.
    """
    if date_from is None:
        return []
    if rule == "year_and_month":
        return [year >= date_from.year, month >= date_from.month]
    if rule == "since":
        return [year >= date_from.year, on >= F.lit(date_from)]
    raise ValueError(f"unknown date filter {rule!r}")


def for_company(company_key: int | None, column: Column) -> list[Column]:
    return [] if company_key is None else [column == company_key]


def e_invoicing_settled(status: Column, state: Column) -> Column:
    """Not emitted electronically, or emitted and accepted."""
    return (status != EMITTED) | ((status == EMITTED) & (state == ACCEPTED))

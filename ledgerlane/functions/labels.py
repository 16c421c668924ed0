"""Text labels of the CRM and inventory reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identification(type_name: Column, number: Column, check_digit: Column) -> Column:
    """``NIT 900123-4``; absent parts are left out."""
    return F.concat_ws(" ", type_name, F.concat_ws("-", number, check_digit))


def contact(
    person_id: Column,
    name: Column,
    first_name: Column,
    second_name: Column,
    type_name: Column,
    number: Column,
    check_digit: Column,
) -> Column:
    """Name and identification of a contact, or ``''`` without one.

    A contact without a full name shows first, second, first and first name again: the report has always repeated it.
    """
    parts = F.concat_ws(" ", first_name, second_name, first_name, first_name)
    label = F.concat_ws(" ", F.coalesce(name, parts), type_name, F.concat_ws("-", number, check_digit))
    return F.when(person_id.isNull(), F.lit("")).otherwise(label)


def sql_datetime(ts: Column) -> Column:
    """A zoneless timestamp as ``YYYY-MM-DD HH:MM:SS`` text, whatever the session time zone."""
    return F.substring(ts.cast("string"), 1, 19)

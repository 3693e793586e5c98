"""Column expressions shared by staging, dimensions and cube."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key of the "all" member of every dimension.
ALL = -1


def month_first_timestamp(text: Column) -> Column:
    """Zone-less timestamp from month/day/year text."""
    return F.to_timestamp_ntz(text, F.lit("M/d/yyyy"))


# Calendar key YYYYMMDD of a column as an integer, by arithmetic rather than by formatting text.
DATE_KEY = "CAST(year({0}) * 10000 + month({0}) * 100 + dayofmonth({0}) AS int)"


def line_value(price: Column, quantity: Column) -> Column:
    return price * quantity


def line_profit(price: Column, cost: Column, quantity: Column) -> Column:
    """(unit price - average cost) * quantity; a product never bought costs 0."""
    return (price - F.coalesce(cost, F.lit(0).cast("decimal(1,0)"))) * quantity

"""Amount expressions.

Money is DECIMAL(20,6). Spark rounds a decimal product whose exact type is wider than 38 digits, so every factor
is cast to a width that keeps the product exact (or, for line x rate, rounds beyond the tenth decimal only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,6)"
LINE = "decimal(38,12)"
REPORT = "decimal(30,8)"

# Fixed value: the invoice type whose refunds reduce the sale.
REFUNDABLE_TYPE = "INS"


def no_money() -> Column:
    return F.lit(0).cast(MONEY)


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, no_money())


def exchange_rate(rate: Column) -> Column:
    """The rate, or 1 where it is zero or NULL."""
    return F.when(rate != 0, rate).otherwise(F.lit(1)).cast("decimal(14,6)")


def net_header_amount(
    subtotal: Column,
    discount: Column,
    rate: Column,
    type_code: Column | None = None,
    has_refund: Column | None = None,
    refund_ingress: Column | None = None,
    refund_discount: Column | None = None,
) -> Column:
    """Subtotal less discount in company currency; with the refund columns, refundable invoices also lose their refund."""
    net = subtotal - discount
    if type_code is not None:
        refunded = F.when(has_refund, no_money()).otherwise(refund_ingress + refund_discount)
        net = F.when(type_code == REFUNDABLE_TYPE, net - refunded).otherwise(net)
    return (net.cast("decimal(23,6)") * exchange_rate(rate)).cast(LINE)


def line_amount(quantity: Column, unit_value: Column) -> Column:
    """Quantity times unit value, exact to twelve decimals."""
    return (quantity.cast("decimal(18,6)") * unit_value.cast("decimal(19,6)")).cast(LINE)


def net_detail_amount(
    quantity: Column,
    unit_value: Column,
    rate: Column,
    is_present: Column,
    type_code: Column | None = None,
    has_refund: Column | None = None,
    quantity_refund: Column | None = None,
) -> Column:
    """Line value in company currency; gifts are worth 0 and refundable lines lose the refunded quantity."""
    sold = quantity
    if type_code is not None:
        kept = quantity - F.when(has_refund, no_money()).otherwise(quantity_refund)
        sold = F.when(type_code == REFUNDABLE_TYPE, kept).otherwise(quantity)
    line = line_amount(sold, unit_value)
    foreign = (line.cast("decimal(24,10)") * exchange_rate(rate)).cast(LINE)
    # Most lines are in company currency: those stay exact and skip the wide multiplication.
    value = F.when(exchange_rate(rate) == 1, line).otherwise(foreign)
    return F.when(is_present, F.lit(0).cast(LINE)).otherwise(value)

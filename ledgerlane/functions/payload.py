"""Reading the JSON payment and tax payloads: arrays of objects whose keys come in several spellings.

Text fields keep their JSON form (``"01"`` and ``1`` stay different values, JSON ``null`` stays ``null``), so grouping on
them and writing them back loses nothing.
"""

from __future__ import annotations

from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.money import MONEY, or_zero


class Field(NamedTuple):
    name: str
    kind: Literal["json", "flag", "amount"]
    aliases: tuple[str, ...]


# Payload keys, in the order they are tried.
PAYMENT_FIELDS: tuple[Field, ...] = (
    Field("payment_type_code", "json", ("PaymentTypeCode", "paymentTypeCode", "payment_type_code")),
    Field("payment_type_name", "json", ("PaymentTypeName", "paymentTypeName", "payment_type_name")),
    Field("payment_type_is_cash", "flag", ("PaymentTypeIsCash", "paymentTypeIsCash", "payment_type_is_cash")),
    Field("account_code_bankcash", "json", ("AccountCode_Bankcash", "accountCode_Bankcash", "account_code_bankcash")),
    Field("account_name_bankcash", "json", ("AccountName_Bankcash", "accountName_Bankcash", "account_name_bankcash")),
    Field("invoice_payment_value", "amount", ("InvoicePaymentValue", "invoicePaymentValue", "invoice_payment_value")),
    Field(
        "invoice_payment_reference",
        "json",
        ("InvoicePaymentReference", "invoicePaymentReference", "invoice_payment_reference"),
    ),
)

# Fixed values. The tax name is looked up under these misspelt keys only, unless ``tax_fields(real_names=True)``.
TAX_FIELDS: tuple[Field, ...] = (
    Field("tax_id", "json", ("TaxId", "taxId", "tax_id")),
    Field("tax_name", "json", ("TaxNametaxName", "taxNametaxName", "tax_nametax_name")),
    Field("tax_category", "json", ("TaxCategory", "taxCategory", "tax_category")),
    Field("tax_is_sum", "flag", ("TaxIsSum", "taxIsSum", "tax_is_sum")),
    Field("tax_percent_value", "amount", ("TaxPercentValue", "taxPercentValue", "tax_percent_value")),
    Field("tax_base", "amount", ("TaxBase", "taxBase", "tax_base")),
    Field("tax_is_discriminate", "flag", ("TaxIsDiscriminate", "taxIsDiscriminate", "tax_is_discriminate")),
    Field("tax_exemption_reason", "json", ("TaxExemptionReason", "taxExemptionReason", "tax_exemption_reason")),
    Field("sub_total", "amount", ("_SubTotal", "_subTotal", "SubTotal", "subTotal")),
    Field("value_total", "amount", ("_ValueTotal", "_valueTotal", "ValueTotal", "valueTotal")),
)

# The keys a tax name is really stored under.
REAL_TAX_NAMES: tuple[str, ...] = ("TaxName", "taxName", "tax_name")


def tax_fields(real_names: bool = False) -> tuple[Field, ...]:
    """The tax fields, optionally with the real tax-name keys tried after the misspelt ones."""
    if not real_names:
        return TAX_FIELDS
    return tuple(
        field._replace(aliases=field.aliases + REAL_TAX_NAMES) if field.name == "tax_name" else field
        for field in TAX_FIELDS
    )


#: A key may come twice in an object; as in the source database the last value counts. Spark refuses such text otherwise.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def allow_repeated_keys(df: DataFrame) -> DataFrame:
    """``df``, if its session reads objects with repeated keys; every job that reads payloads asks for it.

    The setting belongs to the session, so its owner makes it (``ledgerlane.session.prepare``): a plan runs later than it is made, when a setting made
    here might be gone, and other work of the session would see it.
    """
    if df.sparkSession.conf.get(REPEATED_KEYS) != "true":
        raise ValueError(f"set {REPEATED_KEYS} to true, payloads may repeat a key")
    return df


def elements(payload: Column) -> Column:
    """The elements of a JSON array as ARRAY<VARIANT>; NULL for NULL, malformed or non-array text."""
    return F.try_variant_get(F.try_parse_json(payload), "$", "array<variant>")


def is_malformed(payload: Column) -> Column:
    return payload.isNotNull() & F.try_parse_json(payload).isNull()


def entry(element: Column) -> Column:
    """The keys and values of one element; NULL when it is not an object. Much cheaper than one path lookup per key."""
    return F.try_variant_get(element, "$", "map<string, variant>")


def read_field(entry: Column, field: Field) -> Column:
    """One field of one entry: the first spelling that is present decides, even when it holds JSON null."""
    value = F.coalesce(*(entry[alias] for alias in field.aliases))
    if field.kind == "json":
        return F.to_json(value)
    if field.kind == "flag":
        return F.coalesce(F.to_json(value) == "true", F.lit(False))
    return or_zero(F.try_variant_get(value, "$", MONEY))


def read_fields(entry: Column, fields: tuple[Field, ...]) -> list[Column]:
    return [read_field(entry, field).alias(field.name) for field in fields]


def json_value(text: Column) -> Column:
    """JSON text back as a value, so that it nests in a larger JSON object unquoted."""
    return F.parse_json(text)

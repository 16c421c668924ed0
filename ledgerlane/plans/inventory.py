"""Serial numbers whose stock does not add up, and their movement history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.conditions import every, for_company
from ledgerlane.functions.labels import sql_datetime
from ledgerlane.functions.money import MONEY, no_money
from ledgerlane.operators.lookup import lookup
from ledgerlane.operators.numbering import number_rows
from ledgerlane.sources.publish import scratch_scope
from ledgerlane.sources.tables import Tables

# Movement types, the status of an applied movement, and report texts.
INCOME, OUTCOME = "IN", "OT"
APPLIED = "A"
ENTRY, EXIT = "Entrada", "Salida"
MOVEMENT_TITLE = "Movimiento de inventario # "

# Flow column -> report heading.
HEADINGS = {
    "idx": "#",
    "item_id": "Tipo",
    "item_code": "Cód producto",
    "item_name": "Nombre producto",
    "item_serial_number": "Serial",
    "inventory_incomes": "Entradas",
    "inventory_outcomes": "Salidas",
    "expected_stock": "Stock",
    "inventory_consecutive": "Movimiento de inventario",
    "inventory_description": "Descripción",
}

SERIAL = ["company_key", "item_id", "item_serial_number"]
_SERIAL_ORDER = ["expected_stock", "item_code", "item_serial_number", "company_key", "item_id"]


def _signed(quantity: Column, kind: Column) -> Column:
    """Incomes count up, every other movement counts down."""
    return F.when(kind == INCOME, quantity).otherwise(-quantity)


def broken_serials(tables: Tables, company_key: int | None = None, ordered: bool = False) -> DataFrame:
    """Serials of stocked, serial-tracked items whose applied movements do not add up.

    Broken means more outcomes than incomes, or a remaining stock after at least one outcome with more than one unit
    missing. The sums are partial before the shuffle, so a serial with very many movements is no hot spot; an inventory
    document with very many is split by the adaptive skew join. Only serials that can be broken meet their item, so neither
    movements nor the item's code and name are shuffled for it; an item listed more than once counts each time.
    """
    company = for_company(company_key, F.col("company_key"))
    items = (
        tables["erp_item"]
        .where(every([*company, F.col("item_is_stock"), F.col("item_has_serial")]))
        .groupBy("company_key", F.col("id").alias("item_id"), "item_code", "item_name")
        .agg(F.count("*").alias("_times"))
    )
    applied = (
        tables["erp_inventory"]
        .where(every([*company, F.col("inventory_status") == APPLIED]))
        .select("company_key", F.col("id").alias("inventory_id"))
    )
    quantity, kind = F.col("inventory_detail_quantity"), F.col("inventory_detail_type")
    movements = (
        tables["erp_inventory_detail"]
        .where(every([*company, F.col("item_id").isNotNull()]))
        .select("company_key", "inventory_id", "item_id", "item_serial_number", quantity, kind)
    )
    incomes, outcomes = F.col("inventory_incomes"), F.col("inventory_outcomes")
    summed = (
        movements.join(applied, ["company_key", "inventory_id"])
        .groupBy(*SERIAL)
        .agg(
            F.sum(F.when(kind == INCOME, quantity).otherwise(no_money())).alias("inventory_incomes"),
            F.sum(F.when(kind == OUTCOME, quantity).otherwise(no_money())).alias("inventory_outcomes"),
            F.sum(_signed(quantity, kind)).alias("expected_stock"),
        )
        # What no number of listings makes broken.
        .where((incomes < outcomes) | ((F.col("expected_stock") != 0) & (outcomes > 0) & (incomes > outcomes)))
    )
    sums = ["inventory_incomes", "inventory_outcomes", "expected_stock"]
    stock = summed.join(items, ["company_key", "item_id"]).select(
        *SERIAL, "item_code", "item_name", *[(F.col(name) * F.col("_times")).cast(MONEY).alias(name) for name in sums]
    )
    broken = stock.where(
        (incomes < outcomes)
        | ((F.col("expected_stock") != 0) & (outcomes >= 1) & (incomes - 1 > outcomes))
    )
    return broken.orderBy(*_SERIAL_ORDER) if ordered else broken


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def flow_rows(tables: Tables, broken: DataFrame, company_key: int | None = None, order: Sequence[str] = tuple(_SERIAL_ORDER)) -> DataFrame:
    """Header and movement rows of every broken serial, unnumbered, with the columns that order them.

    A serial's movements are all its movements, applied or not. A NULL serial has no rows (see :func:`flow_rejects`).
    ``company_key`` limits the scans of movements and documents, as ``broken`` was limited. ``order`` names the columns of ``broken`` that order its serials.
    """
    company = every(for_company(company_key, F.col("company_key")))
    serials = broken.where(F.col("item_serial_number").isNotNull())
    placed = [F.col(name).alias(f"_{name}") for name in order]
    headers = serials.select(
        *placed,
        F.lit(0).alias("_level"),
        F.lit(None).cast("timestamp_ntz").alias("_created_at"),
        F.lit("").alias("item_id"),
        "item_code",
        "item_name",
        "item_serial_number",
        _text("inventory_incomes"),
        _text("inventory_outcomes"),
        _text("expected_stock"),
        F.lit(None).cast("string").alias("inventory_consecutive"),
        F.lit(None).cast("string").alias("inventory_description"),
    )

    documents = tables["erp_inventory"].where(company).select(
        "company_key",
        F.col("id").alias("inventory_id"),
        "inventory_type",
        "inventory_created_at",
        "inventory_created_tag",
        "inventory_consecutive",
        "inventory_description",
    )
    warehouses = tables["erp_warehouse"]
    origin = warehouses.select(F.col("id").alias("warehouse_id"), F.col("warehouse_name").alias("_from"))
    destination = warehouses.select(F.col("id").alias("_to_id"), F.col("warehouse_name").alias("_to"))
    details = tables["erp_inventory_detail"].where(company).select(
        *SERIAL,
        "inventory_id",
        "inventory_detail_type",
        "inventory_detail_quantity",
        "warehouse_id",
        "warehouse_id_transfer",
        "inventory_detail_created_at",
    )
    moved = (
        details.join(serials.select(*SERIAL, *placed), SERIAL)
        .drop("item_id", "item_serial_number")
        .join(documents, ["company_key", "inventory_id"])
        .join(origin, "warehouse_id")
    )
    moved = lookup(moved, "warehouse_id_transfer", destination, "_to_id")
    kind = F.col("inventory_detail_type")
    movements = moved.select(
        *[f"_{name}" for name in order],
        F.lit(1).alias("_level"),
        F.col("inventory_detail_created_at").alias("_created_at"),
        F.col("inventory_type").alias("item_id"),
        F.concat_ws(" -> ", "_from", "_to").alias("item_code"),
        F.when(kind == INCOME, ENTRY).otherwise(EXIT).alias("item_name"),
        _signed(F.col("inventory_detail_quantity"), kind).cast("string").alias("item_serial_number"),
        sql_datetime(F.col("inventory_created_at")).alias("inventory_incomes"),
        F.coalesce("inventory_created_tag", F.lit("")).alias("inventory_outcomes"),
        F.lit("").alias("expected_stock"),
        F.concat(F.lit(MOVEMENT_TITLE), F.col("inventory_consecutive").cast("string")).alias("inventory_consecutive"),
        "inventory_description",
    )
    return headers.unionByName(movements)


def serial_inventory_flow(tables: Tables, company_key: int | None = None, headings: bool = False) -> DataFrame:
    """The audit listing: each broken serial followed by its movements in creation order, numbered throughout.

    Movements created at the same moment follow in the order of their document number and shown values. This runs jobs: the
    broken serials and the sorted listing are written to scratch folders, which go with the open ``scratch_scope`` or the session.
    """
    # The serials are numbered first, so that their movements travel and are sorted with one number instead of the columns that order the serials.
    # Listings of one serial under several names share its place.
    serials = broken_serials(tables, company_key).where(F.col("item_serial_number").isNotNull())
    listing = F.struct("item_name", "inventory_incomes", "inventory_outcomes")
    listed = serials.groupBy(*_SERIAL_ORDER).agg(F.collect_list(listing).alias("_listings"))
    listed = number_rows(listed, [F.col(name) for name in _SERIAL_ORDER], "place")
    listed = listed.select("place", *_SERIAL_ORDER, F.explode("_listings").alias("_listing")).select("*", "_listing.*").drop("_listing")
    rows = flow_rows(tables, listed, company_key, ["place"])
    order = [
        F.col(name)
        for name in (
            "_place",
            "_level",
            "_created_at",
            "inventory_consecutive",
            "item_name",
            "item_serial_number",
            "item_code",
            "inventory_incomes",
        )
    ]
    numbered = number_rows(rows, order).select(*HEADINGS)
    return numbered.withColumnsRenamed(HEADINGS) if headings else numbered


def write_serial_inventory_flow(tables: Tables, path: str, company_key: int | None = None) -> None:
    """Write the listing to ``path`` and remove the copies it was made from."""
    with scratch_scope(tables["erp_item"].sparkSession):
        serial_inventory_flow(tables, company_key, headings=True).write.parquet(path)


def flow_rejects(tables: Tables, company_key: int | None = None) -> DataFrame:
    """Broken stock without a serial number: it cannot be listed and needs correcting first."""
    return broken_serials(tables, company_key).where(F.col("item_serial_number").isNull())

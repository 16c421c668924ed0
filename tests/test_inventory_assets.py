from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlane.plans import assets, inventory

DAY = datetime(2024, 3, 1, 10)


@pytest.fixture
def stock(make):
    """Movements as (serial, type, quantity[, status]) of one serial-tracked item."""

    def build(*movements, item=None):
        details, documents = [], []
        for n, (serial, kind, quantity, *status) in enumerate(movements):
            document = f"d{n}"
            documents.append(
                {
                    "id": document, "company_key": 1, "inventory_status": status[0] if status else "A",
                    "inventory_type": "AJUSTE", "inventory_consecutive": n, "inventory_created_at": DAY,
                }
            )
            details.append(
                {
                    "company_key": 1, "inventory_id": document, "item_id": "i", "item_serial_number": serial,
                    "inventory_detail_type": kind, "inventory_detail_quantity": D(quantity), "warehouse_id": "w1",
                    "warehouse_id_transfer": "w2" if n % 2 else None,
                    "inventory_detail_created_at": datetime(2024, 3, 20 - n),
                }
            )
        base = {"id": "i", "company_key": 1, "item_code": "C", "item_name": "N", "item_is_stock": True}
        return {
            "erp_item": make("erp_item", {**base, "item_has_serial": True, **(item or {})}),
            "erp_inventory": make("erp_inventory", *documents),
            "erp_inventory_detail": make("erp_inventory_detail", *details),
            "erp_warehouse": make(
                "erp_warehouse", {"id": "w1", "warehouse_name": "Uno"}, {"id": "w2", "warehouse_name": "Dos"}
            ),
        }

    return build


def broken(tables, **options):
    rows = inventory.broken_serials(tables, **options).collect()
    return {row.item_serial_number: (row.inventory_incomes, row.inventory_outcomes, row.expected_stock) for row in rows}


def test_broken_rules(stock):
    tables = stock(
        ("more-out", "IN", 1), ("more-out", "OT", 2),
        ("even", "IN", 1), ("even", "OT", 1),
        ("one-left", "IN", 2), ("one-left", "OT", 1),
        ("two-left", "IN", 4), ("two-left", "OT", 1),
        ("no-out", "IN", 5),
        ("adjusted", "IN", 4), ("adjusted", "OT", 1), ("adjusted", "AJ", 3),
        ("draft", "OT", 5, "P"),
    )
    assert broken(tables) == {"more-out": (1, 2, -1), "two-left": (4, 1, 3)}


def test_other_types_count_as_stock_leaving_but_not_as_outcome(stock):
    assert broken(stock(("s", "IN", 4), ("s", "OT", 1), ("s", "AJ", 1))) == {"s": (4, 1, 2)}


@pytest.mark.parametrize("item", [{"item_is_stock": False}, {"item_has_serial": None}, {"company_key": 2}])
def test_untracked_items_are_left_out(stock, item):
    assert broken(stock(("s", "OT", 1), item=item)) == {}


def test_company_filter(stock):
    assert broken(stock(("s", "OT", 1)), company_key=9) == {}


def test_flow_lists_header_and_all_movements_in_order(stock):
    tables = stock(("b", "OT", 1), ("a", "OT", 2), ("b", "IN", 3, "P"))
    rows = [tuple(row) for row in inventory.serial_inventory_flow(tables).orderBy("idx").collect()]
    assert [row[0] for row in rows] == [1, 2, 3, 4, 5]
    assert rows[0][1:8] == ("", "C", "N", "a", "0.000000", "2.000000", "-2.000000")
    title = "Movimiento de inventario # "
    assert rows[1][1:9] == ("AJUSTE", "Uno -> Dos", "Salida", "-2.000000", "2024-03-01 10:00:00", "", "", f"{title}1")
    assert rows[2][4] == "b"
    assert [row[8] for row in rows[3:]] == [f"{title}2", f"{title}0"]
    assert rows[3][2:5] == ("Uno", "Entrada", "3.000000")


def test_movements_are_sorted_with_one_number_for_their_serial(stock, monkeypatch):
    sorted_columns, number_rows = [], inventory.number_rows
    monkeypatch.setattr(inventory, "number_rows", lambda df, *rest: sorted_columns.append(set(df.columns)) or number_rows(df, *rest))
    inventory.serial_inventory_flow(stock(("b", "OT", 1), ("a", "OT", 2))).count()
    assert sorted_columns[-1] - {*inventory.HEADINGS} == {"_place", "_level", "_created_at"}


def test_an_item_listed_more_than_once_counts_each_time(stock):
    tables = stock(("s", "OT", 1), ("one-left", "IN", 2), ("one-left", "OT", 1))
    again = tables["erp_item"]
    assert broken({**tables, "erp_item": again.union(again)}) == {"s": (0, 2, -2), "one-left": (4, 2, 2)}
    other = {**tables, "erp_item": again.union(again.withColumn("item_name", F.lit("M")))}
    rows = inventory.serial_inventory_flow(other).orderBy("idx").collect()
    assert [(row.idx, row.item_name) for row in rows] == [(1, "M"), (2, "N"), (3, "Salida"), (4, "Salida")]


def test_missing_serial_is_rejected_not_listed(stock):
    tables = stock((None, "OT", 1), ("s", "OT", 1))
    assert [row.item_serial_number for row in inventory.flow_rejects(tables).collect()] == [None]
    assert inventory.serial_inventory_flow(tables).count() == 2


def asset(id="a", base="100", months=3, monthly="33.33", start=date(2024, 1, 31)):
    return {
        "id": id,
        "company_key": 1,
        "item_fixed_asset_base_depreciation": D(base),
        "item_fixed_asset_depreciation_months": months,
        "item_fixed_asset_depreciation_monthly": D(monthly),
        "item_fixed_asset_depreciation_start_date": start,
    }


def schedule(make, **values):
    rows = assets.depreciation_schedule(make("erp_item", asset(**values))).orderBy("depreciation_accumulated").collect()
    return [(row.depreciation_monthly, row.depreciation_accumulated) for row in rows]


def test_shortfall_stays_open(make):
    assert schedule(make)[-1] == (D("33.33"), D("99.99"))


def test_last_instalment_absorbs_the_excess(make):
    assert schedule(make, monthly="33.34") == [(D("33.34"), D("33.34")), (D("33.34"), D("66.68")), (D("33.32"), 100)]


def test_last_instalment_may_turn_negative(make):
    rows = assets.depreciation_schedule(make("erp_item", asset(monthly="60"))).collect()
    assert sorted(row.depreciation_monthly for row in rows) == [-20, 60, 60]


@pytest.mark.parametrize("months", [0, None, -2])
def test_no_months_no_instalments(make, months):
    assert schedule(make, months=months) == []


def stepped(start: date, months: int) -> list[date]:
    """Reference by hand: one month at a time, falling back to the last day."""
    import calendar

    dates, current = [], start
    for _ in range(months):
        year, month = current.year + current.month // 12, current.month % 12 + 1
        current = date(year, month, min(current.day, calendar.monthrange(year, month)[1]))
        dates.append(current)
    return dates


@pytest.mark.parametrize(
    "start",
    [date(2024, 1, 31), date(2023, 1, 31), date(2024, 2, 29), date(2023, 7, 31), date(2095, 12, 30), date(2024, 5, 28),
     date(2096, 3, 29), date(2025, 8, 30)],
)
def test_dates_step_month_by_month(make, start):
    rows = assets.depreciation_schedule(make("erp_item", asset(months=130, start=start))).collect()
    assert sorted(row.depreciation_date for row in rows) == stepped(start, 130)


def log(item="a", id="l", document=None, done=False, company=1):
    return {"id": id, "company_key": company, "item_id": item, "document_id": document, "is_done": done}


def test_rebuild_replaces_open_rows_and_rejects_locked_assets(make):
    items = make("erp_item", asset("free"), asset("booked"), asset("done"), {"id": "no-asset", "company_key": 1})
    rows = make(
        "erp_log_fixed_asset",
        log("free", "open"),
        log("free", "unknown", done=None),
        log("booked", "booked-1", document="x"),
        log("booked", "booked-2"),
        log("done", "done-1", done=True),
        log("done", "done-2"),
        log("no-asset", "other"),
        log("free", "other-company", company=2),
    )
    new_log, rejects = assets.rebuild_depreciation_log(items, rows)
    kept = {row.id for row in new_log.where("depreciation_date IS NULL").collect()}
    assert kept == {"unknown", "booked-1", "booked-2", "done-1", "done-2", "other", "other-company"}
    assert new_log.where("depreciation_date IS NOT NULL AND item_id = 'free' AND is_done IS NULL").count() == 3
    assert new_log.count() == len(kept) + 3
    assert sorted((row.item_id, row.message) for row in rejects.collect()) == [
        ("booked", assets.LOCKED_MESSAGE),
        ("done", assets.LOCKED_MESSAGE),
    ]

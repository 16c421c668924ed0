"""The ERP tables derived from the star-schema sample (orders, lineitem, customer, part, events, ...).

Every rule is plain arithmetic on stored columns, so the work of each job grows with the sample.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlane.functions.money import MONEY
from ledgerlane.functions.payload import PAYMENT_FIELDS, REAL_TAX_NAMES, TAX_FIELDS
from ledgerlane.sources.tables import TENANT

# Spellings 0, 1 and 2 of the payload keys: the first, second and last alias of each field. Spelling 1 writes the tax
# name under its real key, and no tax gives an exemption reason.
PAYMENT_KEYS = {n: [field.aliases[k] for field in PAYMENT_FIELDS] for n, k in enumerate((0, 1, -1))}
TAX_KEYS = {
    n: [
        REAL_TAX_NAMES[1] if (n, field.name) == (1, "tax_name") else field.aliases[k]
        for field in TAX_FIELDS
        if field.name != "tax_exemption_reason"
    ]
    for n, k in enumerate((0, 1, -1))
}


def _text(column: Column) -> Column:
    return column.cast("string")


def _money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def _spelled(spelling: Column, keys: dict[int, list[str]], values: list[Column]) -> Column:
    """JSON object text with the keys of the row's spelling and the given JSON values."""

    def text(names: list[str]) -> Column:
        parts = [F.lit("{")]
        for i, (name, value) in enumerate(zip(names, values, strict=True)):
            parts += [F.lit(f'{"," if i else ""}"{name}":'), value]
        return F.concat(*parts, F.lit("}"))

    return F.when(spelling == 0, text(keys[0])).when(spelling == 1, text(keys[1])).otherwise(text(keys[2]))


class SampleTables:
    """Mapping from ERP table name to its derived DataFrame; a table is only planned when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, table: str) -> DataFrame:
        return _BUILDERS[table](self)

    # ERP and POS documents -------------------------------------------------------------------------------------

    @cached_property
    def documents(self) -> DataFrame:
        """One document per order with its company, branch, seller and states."""
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        return (
            self.raw("orders")
            .join(customer, cust == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key,
                _text(key).alias("id"),
                F.col("n_regionkey").alias("company_key"),
                _text(F.col("c_nationkey")).alias("branch_id"),
                _text(F.nullif(cust % 50, F.lit(0))).alias("person_id_seller"),
                F.when(F.col("o_orderpriority") == "1-URGENT", "INS").otherwise("STD").alias("type_code"),
                (key % 2 == 0).alias("has_refund"),
                _money(key % 7).alias("refund_ingress"),
                _money(key % 3).alias("refund_discount"),
                _money(
                    F.when(key % 10 == 0, F.lit(0)).when(key % 10 == 1, F.lit(3.5)).when(key % 10 != 2, F.lit(1))
                ).alias("rate"),
                _money("o_totalprice").alias("subtotal"),
                _money(key % 100).alias("discount"),
                F.to_date("o_orderdate").alias("date"),
                F.when(F.col("o_orderstatus") == "P", "Anulada").otherwise("Activa").alias("status"),
                F.when(key % 17 == 0, F.lit(None))
                .when(key % 5 == 0, "Emision")
                .otherwise("Ninguno")
                .alias("status_dian"),
                F.when(key % 15 == 0, "Valida").alias("state_dian"),
                F.when(key % 19 == 0, "test").otherwise("production").alias("document_mode"),
            )
        )

    def lines(self, *kinds: int) -> DataFrame:
        documents = self.documents.where((F.col("o_orderkey") % 4).isin(*kinds)).select(
            "o_orderkey", "company_key", F.col("id").alias("document"), "type_code"
        )
        lineitem = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
        )
        return lineitem.join(documents, F.col("l_orderkey") == F.col("o_orderkey"))

    @staticmethod
    def day(column: Column, prefix: str) -> list[Column]:
        return [
            column.alias(f"{prefix}_date"),
            F.year(column).alias(f"{prefix}_year"),
            F.month(column).alias(f"{prefix}_month"),
            F.day(column).alias(f"{prefix}_day"),
        ]

    def erp_documents(self, prefix: str, *kinds: int) -> DataFrame:
        columns = [
            *("id", "company_key", "branch_id", "person_id_seller", "document_mode"),
            F.col("rate").alias("biz_document_exchange_rate"),
            F.col("subtotal").alias("biz_document_subtotal"),
            F.col("discount").alias("biz_document_discount"),
            *self.day(F.col("date"), "biz_document"),
            F.col("status").alias(f"{prefix}_status"),
            F.col("status_dian").alias(f"{prefix}_status_dian"),
            F.col("state_dian").alias(f"{prefix}_state_dian"),
        ]
        if prefix == "invoice":
            columns += [
                F.col(name).alias(f"biz_document_{name}")
                for name in ("type_code", "has_refund", "refund_ingress", "refund_discount")
            ]
        return self.documents.where((F.col("o_orderkey") % 4).isin(*kinds)).select(*columns)

    @property
    def gift(self) -> Column:
        return (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)

    def erp_details(self, *kinds: int) -> DataFrame:
        return self.lines(*kinds).select(
            "company_key",
            F.col("document").alias("biz_document_id"),
            _text(F.col("l_partkey")).alias("item_id"),
            F.col("type_code").alias("biz_document_type_code"),
            self.gift.alias("biz_document_detail_is_present"),
            _money("l_quantity").alias("biz_document_detail_quantity"),
            _money("l_linenumber").alias("biz_document_detail_quantity_refund"),
            _money("l_extendedprice").alias("biz_document_detail_unit_value"),
            *self.day(F.to_date("l_shipdate"), "biz_document_detail"),
        )

    def pos_documents(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = F.when(key % 13 == 0, "OP").when(key % 4 == 0, "PD").when(key % 4 == 1, "CL").otherwise("Parked")
        return self.documents.where(key % 4 != 3).select(
            *("id", "company_key", "branch_id", "person_id_seller", "document_mode"),
            F.lit("IN").alias("invoice_type"),
            status.alias("invoice_status"),
            F.col("subtotal").alias("invoice_subtotal"),
            F.col("discount").alias("invoice_discount"),
            *self.day(F.col("date"), "invoice"),
            F.col("status_dian").alias("invoice_status_dian"),
            F.col("state_dian").alias("invoice_state_dian"),
        )

    def pos_credit_notes(self) -> DataFrame:
        return self.documents.where(F.col("o_orderkey") % 4 == 3).select(
            *("id", "company_key", "branch_id", "person_id_seller", "document_mode"),
            F.col("subtotal").alias("credit_note_subtotal"),
            F.col("discount").alias("credit_note_discount"),
            *self.day(F.col("date"), "credit_note"),
            F.col("status_dian").alias("credit_note_status_dian"),
            F.col("state_dian").alias("credit_note_state_dian"),
        )

    def pos_details(self, prefix: str, *kinds: int) -> DataFrame:
        return self.lines(*kinds).select(
            "company_key",
            F.col("document").alias(f"{prefix}_id"),
            _text(F.col("l_partkey")).alias("item_id"),
            _money("l_quantity").alias(f"{prefix}_detail_quantity"),
            _money("l_extendedprice").alias(f"{prefix}_detail_unit_value"),
            self.gift.alias(f"{prefix}_detail_is_present"),
        )

    # Registers: closures per user and ISO week, their invoices, credit notes, advances and expenses -------------

    def events(self, *types: str) -> DataFrame:
        user = F.col("user_id")
        frame = self.raw("events")
        frame = frame.where(F.col("event_type").isin(*types)) if types else frame
        return frame.select(
            "event_id",
            "ts",
            "user_id",
            _money("value").alias("value"),
            "event_type",
            (user % 5).cast("int").alias("company_key"),
            _text(user % 25).alias("branch_id"),
            _text(user).alias("register_id"),
            F.concat(F.lit("erp_"), _text(user % 5 + 1001)).alias(TENANT),
        )

    def closures(self) -> DataFrame:
        user, week = F.col("user_id"), F.col("week")
        number = user * 6 + week - 1
        return (
            self.events()
            .groupBy(
                "user_id", "company_key", "branch_id", "register_id", TENANT, F.weekofyear("ts").alias("week")
            )
            .agg(F.min("ts").alias("register_opened_at"), F.max("ts").alias("register_closure_created_at"))
            .select(
                F.concat(_text(user), F.lit("-"), _text(week)).alias("id"),
                *("company_key", "branch_id", "register_id", TENANT),
                _text(number * 3).alias("document_id"),
                _text(number * 3 + 1).alias("document_id_advance"),
                _text(number * 3 + 2).alias("document_id_refund"),
                number.alias("register_closure_consecutive"),
                F.to_date("register_closure_created_at").alias("register_closure_date"),
                (user % 3 == 0).alias("register_closure_done"),
                F.when(user % 11 == 0, "Timeout").alias("register_closure_exception"),
                _money(user % 100).alias("register_closure_opening_balance"),
                _money(week).alias("register_closure_recount"),
                *("register_opened_at", "register_closure_created_at"),
                F.col("register_id").alias("register_closure_created_by"),
                F.lit(None).cast("timestamp_ntz").alias("register_closure_updated_at"),
                F.lit(None).cast("string").alias("register_closure_updated_by"),
            )
        )

    def register_invoices(self, keep_snake: bool = True) -> DataFrame:
        """Purchases are sales, errors are refunds. Some payments are doubled with odd values: a text ``"true"``, a
        JSON null and a value in quotes."""
        event = F.col("event_id")
        spelling = F.floor(event / 3) % 3
        if not keep_snake:
            spelling = F.when((spelling == 2) & (F.col("user_id") % 5 == 4), 1).otherwise(spelling)
        value = F.col("value").cast("decimal(20,2)")
        code = event % 3
        quoted = F.lit('"')
        payment = _spelled(
            spelling,
            PAYMENT_KEYS,
            [
                F.concat(quoted, _text(code), quoted),
                F.concat(F.lit('"Pago '), _text(code), quoted),
                F.when(code < 2, "true").otherwise("false"),
                F.concat(quoted, _text(code + 1105), quoted),
                F.lit('"Caja"'),
                _text(value),
                F.concat(F.lit('"R'), _text(event), quoted),
            ],
        )
        odd = _spelled(
            spelling,
            PAYMENT_KEYS,
            [
                *(F.lit("9"), F.lit("null"), F.lit('"true"'), F.lit("null"), F.lit('"Banco"')),
                F.concat(quoted, _text(value), quoted),
                F.lit("null"),
            ],
        )
        tax = _spelled(
            spelling,
            TAX_KEYS,
            [
                _text(event % 2),
                F.lit('"IVA"'),
                F.lit('"VAT"'),
                F.when(event % 5 == 0, "false").otherwise("true"),
                F.lit("19"),
                _text(value),
                F.lit("true"),
                _text(value),
                _text(value * F.lit("0.19").cast("decimal(2,2)")),
            ],
        )
        day = F.to_date("ts")
        return self.events("purchase", "error").select(
            _text(event).alias("id"),
            *("company_key", "branch_id", "register_id", TENANT, "user_id"),
            F.when(F.col("user_id") % 5 != 3, F.col("register_id")).alias("person_id_seller"),
            F.when(F.col("event_type") == "purchase", "IN").otherwise("RF").alias("invoice_type"),
            F.when(event % 2 == 0, "CL").otherwise("PD").alias("invoice_status"),
            event.alias("invoice_consecutive"),
            F.col("value").alias("invoice_subtotal"),
            _money(event % 3).alias("invoice_discount"),
            (F.col("value") + _money(event % 3)).cast(MONEY).alias("invoice_total"),
            *self.day(day, "invoice"),
            F.col("ts").alias("invoice_created_at"),
            F.when(event % 4 == 0, F.concat(F.lit("["), payment, F.lit(","), odd, F.lit("]")))
            .otherwise(F.concat(F.lit("["), payment, F.lit("]")))
            .alias("invoice_payment_types"),
            F.concat(F.lit("["), tax, F.lit("]")).alias("invoice_taxes"),
        )

    def register_credit_notes(self) -> DataFrame:
        return self.events("error").select(
            _text(F.col("event_id")).alias("id"),
            *("company_key", "branch_id", "register_id"),
            F.to_date("ts").alias("credit_note_date"),
            (F.col("event_id") % 2 == 0).alias("credit_note_is_closed"),
        )

    def advances(self) -> DataFrame:
        return self.events("view").select(
            *("event_id", "company_key", "register_id"),
            F.to_date("ts").alias("advance_date"),
            (F.col("event_id") % 2 == 0).alias("advance_is_closed"),
        )

    def expenses(self) -> DataFrame:
        return self.events("signup").select(
            *("event_id", "company_key", "branch_id", "register_id"),
            F.col("ts").alias("expense_date_time"),
            F.col("ts").alias("expense_created_at"),
            F.col("value").alias("expense_amount"),
            (F.col("event_id") % 2 == 0).alias("expense_is_readonly"),
        )

    def branches(self) -> DataFrame:
        return self.raw("nation").select(
            _text(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("branch_name")
        )

    def registers(self) -> DataFrame:
        users = self.raw("events").select("user_id").distinct()
        return users.select(
            _text(F.col("user_id")).alias("id"),
            F.concat(F.lit("Caja "), _text(F.col("user_id"))).alias("register_name"),
        )

    def ledger_documents(self) -> DataFrame:
        return self.raw("orders").select(
            _text(F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("document_description")
        )

    def ledger_details(self) -> DataFrame:
        return self.raw("lineitem").select(
            _text(F.col("l_orderkey")).alias("document_id"),
            F.col("l_returnflag").alias("document_description"),
            F.col("l_linestatus").alias("document_detail_description"),
        )

    # Items, serial movements and fixed assets -------------------------------------------------------------------

    def items(self) -> DataFrame:
        price = _money("p_retailprice")
        return self.raw("part").select(
            _text(F.col("p_partkey")).alias("id"),
            F.lit(0).alias("company_key"),
            F.concat(F.lit("P"), _text(F.col("p_partkey"))).alias("item_code"),
            F.col("p_name").alias("item_name"),
            (F.col("p_size") <= 45).alias("item_is_stock"),
            (F.col("p_type") != "ECONOMY").alias("item_has_serial"),
            price.alias("item_fixed_asset_base_depreciation"),
            F.col("p_size").alias("item_fixed_asset_depreciation_months"),
            _money(F.round(price / F.col("p_size"), 2)).alias("item_fixed_asset_depreciation_monthly"),
            F.lit("2024-01-31").cast("date").alias("item_fixed_asset_depreciation_start_date"),
        )

    def inventory(self) -> DataFrame:
        return self.raw("orders").select(
            _text(F.col("o_orderkey")).alias("id"),
            F.lit(0).alias("company_key"),
            F.when(F.col("o_orderstatus") == "P", "P").otherwise("A").alias("inventory_status"),
            F.col("o_orderpriority").alias("inventory_type"),
            F.col("o_orderkey").alias("inventory_consecutive"),
            F.concat(F.lit("Orden de "), _text(F.col("o_custkey"))).alias("inventory_description"),
            F.col("o_orderdate").alias("inventory_created_at"),
            F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("T"), _text(F.col("o_custkey")))).alias(
                "inventory_created_tag"
            ),
        )

    def movements(self) -> DataFrame:
        supplier = self.raw("supplier").select("s_suppkey", "s_nationkey")
        flag = F.col("l_returnflag")
        return (
            self.raw("lineitem")
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.lit(0).alias("company_key"),
                _text(F.col("l_orderkey")).alias("inventory_id"),
                _text(F.col("l_partkey")).alias("item_id"),
                F.concat(F.lit("S"), _text(F.col("l_suppkey") % 10)).alias("item_serial_number"),
                F.when(flag == "R", "IN").when(flag == "N", "OT").otherwise("AJ").alias("inventory_detail_type"),
                _money("l_quantity").alias("inventory_detail_quantity"),
                _text(F.col("s_nationkey")).alias("warehouse_id"),
                F.when(F.col("l_linenumber") % 2 != 0, _text((F.col("s_nationkey") + 1) % 25)).alias(
                    "warehouse_id_transfer"
                ),
                F.col("l_shipdate").alias("inventory_detail_created_at"),
            )
        )

    def warehouses(self) -> DataFrame:
        return self.raw("nation").select(
            _text(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("warehouse_name")
        )

    def asset_log(self) -> DataFrame:
        """Two older log rows per asset; some are done (which locks the asset) and some have an unknown done flag."""
        part = F.col("p_partkey")
        step = F.col("step")
        done = F.when(step == 1, part % 7 == 0).when(part % 11 != 0, F.lit(False))
        return self.raw("part").select(part, F.explode(F.array(F.lit(1), F.lit(2))).alias("step")).select(
            F.concat(F.lit("L"), _text(part), F.lit("-"), _text(step)).alias("id"),
            F.lit(0).alias("company_key"),
            _text(part).alias("item_id"),
            F.lit(None).cast("string").alias("document_id"),
            done.alias("is_done"),
            F.lit(True).alias("is_enabled"),
            F.lit(False).alias("is_disabled"),
            F.lit(False).alias("is_revaluation"),
            _money(step).alias("depreciation_monthly"),
            _money(step * 2).alias("depreciation_accumulated"),
            F.lit("2023-12-31").cast("date").alias("depreciation_date"),
        )

    # CRM -------------------------------------------------------------------------------------------------------

    def deals(self) -> DataFrame:
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        key = F.col("o_orderkey")
        return (
            self.raw("orders")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("n_regionkey").alias("company_key"),
                F.concat(F.lit("Negocio "), _text(key)).alias("deal_name"),
                _money("o_totalprice").alias("amount"),
                _text(F.col("c_nationkey")).alias("origin_id"),
                _text(F.col("n_regionkey")).alias("pipeline_id"),
                F.col("o_orderstatus").alias("pipeline_stage_id"),
                F.when(key % 9 != 0, _text(F.col("o_custkey"))).alias("person_id"),
                F.when(key % 8 != 0, _text(key % 2000)).alias("item_id"),
                F.col("o_orderdate").alias("created_at"),
            )
        )

    def origins(self) -> DataFrame:
        return self.raw("nation").select(
            _text(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("origin_name")
        )

    def pipelines(self) -> DataFrame:
        return self.raw("region").select(
            _text(F.col("r_regionkey")).alias("id"), F.col("r_name").alias("pipeline_name")
        )

    def stages(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.raw("orders").select(status).distinct().select(
            status.alias("id"),
            F.concat(F.lit("Etapa "), status).alias("pipeline_stage_name"),
            (status == "F").alias("is_won"),
        )

    def people(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text(key).alias("id"),
                F.col("n_regionkey").alias("company_key"),
                F.when(key % 4 != 0, F.col("c_name")).alias("person_name"),
                F.concat(F.lit("F"), _text(key)).alias("person_first_name"),
                F.when(key % 3 != 0, F.concat(F.lit("S"), _text(key))).alias("person_second_name"),
                F.when(segment == "BUILDING", "NIT").otherwise("CC").alias("identification_type_name"),
                _text(key).alias("person_identification"),
                F.when(key % 6 != 0, _text(key % 10)).alias("person_identification_check"),
                F.when(segment == "BUILDING", "Company").otherwise("Person").alias("person_kind"),
                _text(F.col("c_nationkey") % 5).alias("person_status_id"),
                F.when(key % 10 != 3, segment).alias("person_state_id"),
                _text(F.col("c_nationkey")).alias("origin_id"),
                F.date_add(F.lit("1997-06-01").cast("date"), (key % 730).cast("int"))
                .cast("timestamp_ntz")
                .alias("person_created_at"),
            )
        )

    def person_statuses(self) -> DataFrame:
        return self.raw("region").select(
            _text(F.col("r_regionkey")).alias("id"),
            F.col("r_name").alias("person_status_name"),
            (4 - F.col("r_regionkey")).alias("person_status_order"),
        )

    def person_states(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.raw("customer").select(segment).distinct().select(
            segment.alias("id"), F.lower(segment).alias("person_state_name"), F.length(segment).alias("person_state_order")
        )

    # Options and snapshots -------------------------------------------------------------------------------------

    def options(self) -> DataFrame:
        """Option lists per brand: the types, sizes and price bands its parts come in, in value order."""
        band = F.floor(F.col("p_retailprice") / 500).cast("int")
        axes = F.array(
            F.struct(F.lit("type").alias("axis"), F.col("p_type").alias("value")),
            F.struct(F.lit("size").alias("axis"), F.lpad(_text(F.col("p_size")), 2, "0").alias("value")),
            F.struct(F.lit("band").alias("axis"), _text(band).alias("value")),
        )
        options = (
            self.raw("part")
            .select(F.col("p_brand").alias("product"), F.explode(axes).alias("option"))
            .select("product", "option.*")
            .distinct()
        )
        listed = Window.partitionBy("product", "axis").orderBy("value")
        return options.withColumn("pos", F.row_number().over(listed) - 1)

    def customers(self, changed: bool = False, nested: bool = False) -> DataFrame:
        """Customers, or their changed snapshot: some balances and segments differ, some rows exist on one side only."""
        key = F.col("c_custkey")
        balance, segment = F.col("c_acctbal").cast("decimal(12,2)"), F.col("c_mktsegment")
        if changed:
            balance = F.when(key % 10 == 0, balance + 1).otherwise(balance).cast("decimal(12,2)")
            segment = F.when(key % 15 != 0, segment)
        rows = self.raw("customer").where(key % 50 != (1 if changed else 2))
        if not nested:
            return rows.select(key, "c_name", "c_nationkey", balance.alias("c_acctbal"), segment.alias("c_mktsegment"))
        tags = F.array(segment, _text(F.col("c_nationkey")))
        return rows.select(
            key,
            F.struct(F.col("c_name").alias("name"), F.struct(balance.alias("balance")).alias("account")).alias("profile"),
            F.create_map(F.lit("segment"), segment, F.lit("nation"), _text(F.col("c_nationkey"))).alias("facts"),
            tags.alias("tags"),
        )


_BUILDERS: dict[str, Callable[[SampleTables], DataFrame]] = {
    "erp_invoice": lambda s: s.erp_documents("invoice", 0, 1),
    "erp_invoice_debit_note": lambda s: s.erp_documents("invoice_debit_note", 2),
    "erp_invoice_credit_note": lambda s: s.erp_documents("invoice_credit_note", 3),
    "erp_invoice_detail": lambda s: s.erp_details(0, 1),
    "erp_invoice_debit_note_detail": lambda s: s.erp_details(2),
    "erp_invoice_credit_note_detail": lambda s: s.erp_details(3),
    "erp_pos_invoice": SampleTables.pos_documents,
    "erp_pos_credit_notes": SampleTables.pos_credit_notes,
    "erp_pos_invoice_detail": lambda s: s.pos_details("invoice", 0, 1, 2),
    "erp_pos_credit_note_details": lambda s: s.pos_details("credit_note", 3),
    "erp_branch": SampleTables.branches,
    "erp_document": SampleTables.ledger_documents,
    "erp_document_detail": SampleTables.ledger_details,
    "erp_inventory": SampleTables.inventory,
    "erp_inventory_detail": SampleTables.movements,
    "erp_item": SampleTables.items,
    "erp_log_fixed_asset": SampleTables.asset_log,
    "erp_pos_register_closures": SampleTables.closures,
    "erp_pos_registers": SampleTables.registers,
    "erp_warehouse": SampleTables.warehouses,
    "common_person": SampleTables.people,
    "common_person_state": SampleTables.person_states,
    "common_person_status": SampleTables.person_statuses,
    "crm_deals": SampleTables.deals,
    "crm_origins": SampleTables.origins,
    "crm_pipeline_stages": SampleTables.stages,
    "crm_pipelines": SampleTables.pipelines,
}


class RegisterTables(SampleTables):
    """The same sample with the POS tables of the cash registers, derived from the events."""

    def __getitem__(self, table: str) -> DataFrame:
        registers = {
            "erp_pos_invoice": self.register_invoices,
            "erp_pos_credit_notes": self.register_credit_notes,
            "erp_pos_advances": self.advances,
            "erp_pos_expenses": self.expenses,
        }
        return registers[table]() if table in registers else super().__getitem__(table)

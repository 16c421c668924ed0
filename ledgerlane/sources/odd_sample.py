"""The sample tables bent so that the rare cases of the jobs occur in them, still by plain arithmetic on stored columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlane.sources.publish import scratch
from ledgerlane.sources.sample import RegisterTables, _money, _text
from ledgerlane.sources.reconcile import Plan, reading_plan
from ledgerlane.sources.tables import TENANT, read_tables

# Payloads by event number modulo 12; the other events keep the sample's own.
_ODD_PAYMENTS = {
    0: None,
    1: "",
    2: "[",
    3: "5",
    4: '[1, "x", null]',
    5: '{"paymentTypeCode": "1"}',
    # A repeated key: the last value counts.
    6: '[{"paymentTypeCode":"1","paymentTypeIsCash":true,"invoicePaymentValue":1,"invoicePaymentValue":7},{"paymentTypeCode":"2","invoicePaymentValue":3}]',
    # Several spellings in one object: the first in their order decides, also with null.
    7: '[{"payment_type_code":"c","PaymentTypeCode":null,"paymentTypeCode":"b","invoice_payment_value":2,"invoicePaymentValue":4}]',
    8: '[{"payment_type_code":"c","paymentTypeCode":"b","invoice_payment_value":"2.50"}]',
    9: "[]",
}

_WRAPS = [("wrap", 7, "paper"), ("wrap", 3, "box"), ("wrap", 9, "bag"), ("gift", 0, "yes"), ("gift", 1, "no")]


class OddTables(RegisterTables):
    """Registers with odd payloads, shifted closures and tenants of different columns; stock of two companies without some serials."""

    def __getitem__(self, table: str) -> DataFrame:
        bent = {
            "erp_pos_invoice": self.odd_invoices,
            "erp_pos_register_closures": self.shifted_closures,
            "erp_item": self.items_of_two_companies,
            "erp_inventory": self.inventory_of_two_companies,
            "erp_inventory_detail": self.movements_of_two_companies,
            "erp_log_fixed_asset": self.linked_asset_log,
        }
        return bent[table]() if table in bent else super().__getitem__(table)

    def odd_invoices(self) -> DataFrame:
        kind, payload = F.col("invoice_consecutive") % 12, F.col("invoice_payment_types")
        chosen = F.when(kind > max(_ODD_PAYMENTS), payload)
        for number, text in _ODD_PAYMENTS.items():
            chosen = chosen.when(kind == number, F.lit(text).cast("string"))
        taxes = F.when(F.col("invoice_consecutive") % 25 == 0, "{no JSON").otherwise(F.col("invoice_taxes"))
        return self.register_invoices().withColumns({"invoice_payment_types": chosen, "invoice_taxes": taxes})

    def shifted_closures(self) -> DataFrame:
        """By register: opened a day late (rows fall before it), closed three days late (rows fall into two), closed years ago, or from the
        year 1 on (a wrong opening time)."""
        kind = F.col("register_id").cast("int") % 5
        opened, closed = F.col("register_opened_at"), F.col("register_closure_created_at")
        return self.closures().withColumns(
            {
                "register_opened_at": F.when(kind == 0, opened + F.expr("INTERVAL 1 DAY"))
                .when(kind == 4, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
                .otherwise(opened),
                "register_closure_created_at": F.when(kind == 1, closed + F.expr("INTERVAL 3 DAYS"))
                .when(kind == 2, closed - F.expr("INTERVAL 3 YEARS"))
                .otherwise(closed),
            }
        )

    def items_of_two_companies(self) -> DataFrame:
        return self.items().drop("company_key").withColumn("company_key", F.explode(F.array(F.lit(0), F.lit(1))))

    def inventory_of_two_companies(self) -> DataFrame:
        return self.inventory().withColumn("company_key", (F.col("inventory_consecutive") % 2).cast("int"))

    def movements_of_two_companies(self) -> DataFrame:
        serial = F.col("item_serial_number")
        return self.movements().withColumns(
            {"company_key": (F.col("inventory_id").cast("long") % 2).cast("int"), "item_serial_number": F.when(serial != "S3", serial)}
        )

    def linked_asset_log(self) -> DataFrame:
        """Some rows are booked to a document and not done."""
        booked = F.when(F.col("item_id").cast("int") % 13 == 0, F.concat(F.lit("D"), F.col("item_id")))
        return self.asset_log().withColumn("document_id", booked)

    def gappy_options(self) -> DataFrame:
        """Positions 2, 5, 8, ... and some products without price bands."""
        bandless = (F.col("axis") == "band") & F.col("product").endswith("1")
        return self.options().where(~bandless).withColumn("pos", F.col("pos") * 3 + 2)

    def spelled_invoices(self) -> DataFrame:
        """Invoices whose modes, states and branches come in several spellings."""
        kind = F.col("id").cast("long")

        def spelled(column: str, spellings: dict[str, list[str]], by: int):
            chosen = F.col(column)
            for value, others in spellings.items():
                for number, other in enumerate(others):
                    chosen = F.when((F.col(column) == value) & ((kind / by).cast("long") % (len(others) + 1) == number), other).otherwise(chosen)
            return chosen

        names = self.raw("nation").select(F.col("n_nationkey").cast("string").alias("branch_id"), F.col("n_name").alias("name"))
        branch = F.when(kind % 3 == 0, F.lower("name")).when(kind % 3 == 1, F.translate("name", "AEIOU", "ÁÉÍÓÚ")).otherwise(F.col("name"))
        rows = self["erp_invoice"].join(names, "branch_id").drop("branch_id").withColumn("branch_id", branch).drop("name")
        return rows.withColumns(
            {
                "document_mode": spelled("document_mode", {"production": ["PRODUCTION", "Prodúction"], "test": ["TEST"]}, 1),
                "invoice_status": spelled("invoice_status", {"Anulada": ["ANULADA", "anuláda"], "Activa": ["ACTIVA"]}, 2),
                "invoice_status_dian": spelled("invoice_status_dian", {"Emision": ["Emisión", "EMISION"]}, 5),
                "invoice_state_dian": spelled("invoice_state_dian", {"Valida": ["Válida", "VALIDA"]}, 15),
            }
        )

    def ragged_options(self) -> tuple[DataFrame, DataFrame]:
        """Option lists of brands, by brand number modulo 5: none; bands; types, sizes and bands; these with wraps and gifts; types and an empty list."""
        kind = F.regexp_extract("product", r"([0-9]+)", 1).cast("int") % 5
        names = {1: ["band"], 2: ["type", "size", "band"], 3: ["type", "wrap", "band", "gift", "size"], 4: ["type", "nothing"]}
        products = self.raw("part").select(F.col("p_brand").alias("product")).distinct()
        listed = F.lit(None).cast("array<string>")
        for number, axes in names.items():
            listed = F.when(kind == number, F.array(*map(F.lit, axes))).otherwise(listed)
        axes = products.select("product", F.posexplode_outer(listed).alias("axis_no", "axis"))
        more = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(p).alias("pos"), F.lit(v).alias("value")) for a, p, v in _WRAPS]))
        options = self.options().select("product", "axis", F.col("pos").cast("int").alias("pos"), "value")
        return axes, options.unionByName(products.select("product", more.alias("option")).select("product", "option.*"))

    def stored_tenant_invoices(self) -> DataFrame:
        """The register invoices written per tenant, one tenant without the seller column, another with a column of its own."""
        root = scratch(self.spark, "tenants")
        invoices = self.register_invoices(keep_snake=False).select(
            TENANT, "id", "register_id", "person_id_seller", "invoice_status", "invoice_payment_types"
        )
        for tenant in (f"erp_{number}" for number in range(1001, 1006)):
            own = invoices.where(F.col(TENANT) == tenant).drop(TENANT)
            own = own.drop("person_id_seller") if tenant == "erp_1004" else own
            own = own.withColumn("loyalty_code", F.col("id")) if tenant == "erp_1002" else own
            own.write.parquet(f"{root}/erp_pos_invoice/{TENANT}={tenant}")
        return read_tables(self.spark, root, ["erp_pos_invoice"])["erp_pos_invoice"]

    def drifted_invoices(self) -> Plan:
        """Invoices stored per tenant, ``amount`` and other columns under another type in each; the declared type of ``amount`` is exact."""
        root = scratch(self.spark, "drifted")
        event, user, value = F.col("event_id"), F.col("user_id"), F.col("value").cast("decimal(18,2)")
        moment = F.date_trunc("second", "ts").cast("timestamp_ntz")
        day, number = F.to_date(moment), _text(event)
        odd = F.when(event % 9 == 0, "n/a").otherwise(value.cast("string"))
        kinds = {
            "erp_1001": (number, user.cast("int"), value.cast("double") + F.when(event % 10 == 0, 1e-7).otherwise(0.0), day, None),
            "erp_1002": (event, user.cast("long"), value, moment, None),
            "erp_1003": (number, user.cast("int"), value.cast("int"), day, F.array((event % 3).cast("int"))),
            "erp_1004": (number, F.concat(F.lit("R"), _text(user)), odd, day, None),
            "erp_1005": (number, (user + F.lit(0.5)).cast("decimal(12,1)"), value.cast("long"), day.cast("string"), F.when(event % 2 == 0, number)),
        }
        rows = self.raw("events").where(F.col("event_type").isin("purchase", "error"))
        for place, (tenant, columns) in enumerate(kinds.items()):
            named = [column.alias(name) for name, column in zip(("id", "register", "amount", "opened", "extra"), columns) if column is not None]
            rows.where(user % 5 == place).select(*named).write.parquet(f"{root}/{TENANT}={tenant}")
        return reading_plan(self.spark, root, StructType.fromDDL("amount decimal(20,6)"))

    def restructured_customers(self, changed: bool = False) -> DataFrame:
        """Customers before and after a change of columns: one gone, one new, one of another type, a new nested field, a key with a dot."""
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        balance = F.when(key % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")) if changed else F.col("c_acctbal")
        profile = [F.col("c_name").alias("name"), _money(balance).alias("balance")]
        facts = F.create_map(F.lit("seg.ment"), F.when(key % 15 != 0, segment) if changed else segment)
        rows = self.raw("customer")
        if not changed:
            return rows.select(key, F.struct(*profile).alias("profile"), facts.alias("facts"), "c_nationkey", _text(key % 7).alias("gone"))
        extra = F.when(key % 4 == 0, F.concat(F.lit("x"), _text(key))).alias("extra")
        return rows.select(
            key, F.struct(*profile, extra).alias("profile"), facts.alias("facts"), _text(F.col("c_nationkey")).alias("c_nationkey"), _text(key % 3).alias("added")
        )



    def payload_snapshot(self, changed: bool = False) -> DataFrame:
        """Invoices with two payloads as schemaless values, before and after a change of their texts.

        Order of names and spelling of numbers change everywhere, which is no difference. Some members get another value, another kind or none,
        some lists an element more or less, some texts are malformed, and some invoices are missing on one side.
        """
        event, value = F.col("event_id"), F.col("value").cast("decimal(18,2)").cast("string")

        def text(*parts):
            return F.concat(*[F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts])

        def when(test, then, otherwise=""):
            given = [F.lit(v) if isinstance(v, str) else v.cast("string") for v in (then, otherwise)]
            return F.when(test, given[0]).otherwise(given[1])

        if not changed:
            payment = text('[{"code":"', event % 3, '","amount":', value, ',"lines":[', event % 4, ",[", event % 5, ']],"meta":{"at":{"k":', event % 2, '},"note":null}}')
            payment = F.concat(payment, when(event % 6 == 0, ',{"a":"x","b":[]}'), F.lit("]"))
            tax = when(event % 8 == 0, '{"rate":19', text('{"rate":', event % 3, ',"names":["IVA","', event % 4, '"]}'))
            kept = event % 17 != 0
        else:
            note = when(event % 7 == 0, '"n"', "null")
            at = when(event % 11 == 0, '{"at":7,', text('{"at":{"k":', event % 2, when(event % 14 == 0, ',"z.z":[1,{"a":1}]'), "},"))
            lines = text('"lines":[', event % 4, when(event % 5 > 0, text(",[", event % 5 + (event % 13 == 0).cast("int"), "]")), "]")
            amount = text(',"amount":', when(event % 10 == 0, text(value, "7"), text(value, "00")))
            code = when(event % 9 == 0, text(event % 3), text('"', event % 3, '"'))
            payment = F.concat(F.lit('[{"meta":'), at, F.lit('"note":'), note, F.lit("},"), lines, amount, F.lit(',"code":'), code, F.lit("}]"))
            tax = when(event % 12 == 0, '[1e1]', text('{"names":["IVA","', event % 4, '"', when(event % 5 == 0, ',"ICA"'), '],"rate":', event % 3, ".0}"))
            kept = event % 19 != 0
        rows = self.raw("events").where(F.col("event_type").isin("purchase", "error") & kept)
        return rows.select(event.cast("string").alias("id"), F.try_parse_json(payment).alias("payments"), F.try_parse_json(tax).alias("taxes"), F.col("user_id"))

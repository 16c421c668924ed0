"""Checks on physical plans: no Python in the data path, no pairwise joins, and hot keys split at run time."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlane import registry
from ledgerlane.operators import interval
from ledgerlane.operators.interval import day_spans, join_intervals
from ledgerlane.plans import sales
from ledgerlane.plans.closures import expense_totals

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_plan_stays_in_the_engine(spark, name):
    plan = physical(registry.queries()[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    if "SinglePartition" in plan:
        # Totals without a key, over one number per partition; nothing else may end in one task.
        assert name in {
            *("serial_inventory_flow", "serial_inventory_flow_of_company", "reopened_counts"),
            *("column_drift", "column_drift_stored", "payload_key_drift"),
            "closure_reference_lists",
        }


def test_filters_and_columns_reach_the_scan(spark, make, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    make("erp_invoice", {"id": "1"}).write.parquet(f"{tmp_path}/erp_invoice")
    stored = spark.read.parquet(f"{tmp_path}/erp_invoice")
    plan = physical(sales.eligible_documents(stored, "invoice", company_key=1, date_from=date(2023, 6, 1)).select("id"))
    pushed = re.search(r"PushedFilters: (.*?)\], ReadSchema: (.*)", plan, re.S)
    for test in ("EqualTo(company_key,1)", "EqualTo(document_mode,production)", "GreaterThanOrEqual(biz_document_year,2023)"):
        assert test in pushed[1]
    assert "biz_document_subtotal" not in pushed[2]


@pytest.fixture
def split_hot_keys(spark):
    """Thresholds small enough for test data; broadcasting off, so that joins shuffle."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return physical(df)


def test_hot_day_of_one_register_is_split(spark, monkeypatch, split_hot_keys):
    monkeypatch.setattr(interval, "BROADCAST_DAYS", 0)
    keys = ["company_key", "branch_id", "register_id"]
    opened, closed = datetime(2024, 1, 1), datetime(2024, 1, 2)
    closures = spark.range(30).select(
        F.col("id").cast("string").alias("register_closure_id"),
        F.lit(1).alias("company_key"),
        F.lit("b").alias("branch_id"),
        F.col("id").cast("string").alias("register_id"),
        F.lit(opened).cast("timestamp_ntz").alias("opened"),
        F.lit(closed).cast("timestamp_ntz").alias("closed"),
    )
    register = F.when(F.col("id") % 3 != 0, F.col("id") % 30).otherwise(7).cast("string")
    expenses = spark.range(0, 60_000, 1, 8).select(
        F.lit(1).alias("company_key"),
        F.lit("b").alias("branch_id"),
        register.alias("register_id"),
        F.lit(datetime(2024, 1, 1, 12)).cast("timestamp_ntz").alias("at"),
        F.col("id").cast("decimal(20,6)").alias("expense_amount"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    joined = join_intervals(day_spans(closures, "opened", "closed"), expenses, keys, "at")
    totals = expense_totals(joined.where(F.length("note") > 0))
    assert "skew=true" in final_plan(totals)
    assert sum(row.expense_total for row in totals.collect()) == 60_000 * 59_999 / 2


def test_document_with_a_third_of_all_lines_is_split(spark, make, split_hot_keys):
    on = date(2024, 1, 5)
    documents = spark.range(500).select(
        F.col("id").cast("string").alias("id"),
        F.lit(1).alias("company_key"),
        F.lit("b").alias("branch_id"),
        F.lit("production").alias("document_mode"),
        F.lit("Activa").alias("invoice_status"),
        F.lit("Ninguno").alias("invoice_status_dian"),
    )
    empty = make("erp_invoice")
    documents = documents.unionByName(empty, allowMissingColumns=True).select(*empty.columns)
    key = F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id") % 500).cast("string")
    lines = spark.range(0, 90_000, 1, 8).select(
        F.lit(1).alias("company_key"),
        key.alias("biz_document_id"),
        F.sha2((F.col("id") % 50).cast("string"), 256).alias("item_id"),
        F.lit(False).alias("biz_document_detail_is_present"),
        F.lit(2).cast("decimal(20,6)").alias("biz_document_detail_quantity"),
        F.lit(3).cast("decimal(20,6)").alias("biz_document_detail_unit_value"),
        F.lit(on).alias("biz_document_detail_date"),
        F.lit(2024).alias("biz_document_detail_year"),
        F.lit(1).alias("biz_document_detail_month"),
        F.lit(5).alias("biz_document_detail_day"),
    )
    blank = make("erp_invoice_detail")
    tables = {
        "erp_invoice": documents,
        "erp_invoice_detail": lines.unionByName(blank, allowMissingColumns=True).select(*blank.columns),
        "erp_invoice_debit_note": make("erp_invoice_debit_note"),
        "erp_invoice_credit_note": make("erp_invoice_credit_note"),
        "erp_invoice_debit_note_detail": make("erp_invoice_debit_note_detail"),
        "erp_invoice_credit_note_detail": make("erp_invoice_credit_note_detail"),
    }
    report = sales.sales_by_item(tables)
    assert "skew=true" in final_plan(report)
    assert sum(row.sales_total for row in report.collect()) == 90_000 * 6


def test_sums_run_before_the_shuffle(spark):
    plan = physical(registry.queries()["sales_by_branch"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(company_key", plan)) == 1
    assert "partial_sum" in plan

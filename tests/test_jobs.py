"""Jobs over stored tables: report refreshes, partition-wise corrections, payload rejects, copies that go."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlane.plans import closures, corrections, crm, inventory, refresh
from ledgerlane.sources import publish
from ledgerlane.sources.odd_sample import OddTables
from ledgerlane.sources.publish import read_current, shared_folder
from ledgerlane.sources.sample import RegisterTables, SampleTables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "job, reports, family", [(refresh.refresh_sales_reports, refresh.ERP_REPORTS, "erp"), (refresh.refresh_pos_sales_reports, refresh.POS_REPORTS, "pos")]
)
def test_refresh_twice_gives_the_same_reports(spark, tmp_path, job, reports, family):
    tables, runs, root = SampleTables(spark, SF), [], f"{tmp_path}/{family}"
    for _ in range(2):
        job(tables, str(tmp_path))
        runs.append({name: sorted(map(str, read_current(spark, root, name).collect())) for name in reports})
    assert runs[0] == runs[1] and all(runs[0].values())  # ids too
    for name, (plan, key) in reports.items():
        current = read_current(spark, root, name)
        assert sorted(map(str, current.drop("id").collect())) == sorted(map(str, plan(tables).select(*current.drop("id").columns).collect()))
        assert current.count() == current.select(*key).distinct().count() == current.select("id").distinct().count()


def test_a_failed_report_leaves_all_as_they_were(spark, tmp_path, monkeypatch):
    tables, root = SampleTables(spark, SF), str(tmp_path)
    refresh.refresh_sales_reports(tables, root, company_key=1)
    before = {name: read_current(spark, f"{root}/erp", name).count() for name in refresh.ERP_REPORTS}
    job = refresh.sales.sales_reports

    def broken(*args, **kwargs):
        branch, seller, item = job(*args, **kwargs)
        return branch, seller, item.withColumn("sales_total", F.raise_error(F.lit("disk full")).cast("decimal(20,6)"))

    monkeypatch.setattr(refresh.sales, "sales_reports", broken)
    with pytest.raises(Exception, match="disk full"):
        refresh.refresh_sales_reports(tables, root)
    assert {name: read_current(spark, f"{root}/erp", name).count() for name in refresh.ERP_REPORTS} == before


def test_a_refresh_reads_every_table_once(spark, tmp_path, whole_plans):
    """The plans of all that a refresh runs: each document and detail table is scanned in one of them."""
    names = [table for kind in refresh.sales.ERP_KINDS for table in (refresh.sales.KINDS[kind].table, refresh.sales.KINDS[kind].detail_table)]
    sample = SampleTables(spark, SF)
    for name in names:
        sample[name].write.parquet(f"{tmp_path}/tables/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/tables/{name}") for name in names}
    reads, found = dict.fromkeys(names, 0), []
    headers = refresh.sales.store

    def told(df, label):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return headers(df, label)

    from unittest import mock

    with mock.patch.object(refresh.sales, "store", told):
        found += [frame._jdf.queryExecution().executedPlan().toString() for frame in refresh.sales.sales_reports(tables)]
    for plan in found:
        for line in plan.split("== Initial Plan ==")[0].splitlines():
            for name in names:
                reads[name] += "FileScan" in line and f"/tables/{name}]" in line
    assert set(reads.values()) == {1}, reads


def test_a_failed_overwrite_can_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(100).selectExpr("id", "id % 5 AS part", "'old' AS note").write.partitionBy("part").parquet(path)
    overwrite = publish._overwrite

    def half(rows, target, partition_by):
        """One partition is gone and only some of its rows are written."""
        overwrite(rows.where("part = 2 AND id < 50"), target, partition_by)
        raise OSError("disk full")

    monkeypatch.setattr(publish, "_overwrite", half)
    with pytest.raises(publish.UnfinishedRewrite) as failed:
        publish.rewrite_partitions(spark, path, lambda df: df.where("part IN (2, 3)"), lambda df: df.withColumn("note", F.lit("new")), ["part"])
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 90 and spark.read.parquet(failed.value.copy).count() == 40
    publish.finish_rewrite(spark, failed.value.path, failed.value.copy, failed.value.partition_by)
    rows = spark.read.parquet(path)
    assert rows.count() == 100 and rows.where("note = 'new'").count() == 40 and not Path(failed.value.copy.removeprefix("file:")).exists()


def _stored(spark, root, tables, by):
    for name, columns in by.items():
        frame = tables[name]
        if "_bucket" in columns:
            frame = frame.withColumn("_bucket", F.floor(F.col("document_id" if name.endswith("detail") else "id").cast("long") / 300))
        frame.write.partitionBy(*columns).parquet(f"{root}/{name}")


def _files(root):
    return {file: file.stat().st_mtime_ns for file in Path(root).rglob("*.parquet")}


def test_reopening_rewrites_the_registers_partitions_only(spark, tmp_path):
    tables, root = RegisterTables(spark, SF), str(tmp_path)
    _stored(spark, root, tables, {row[0]: ["company_key", row[1]] if row[1] != "expense_date_time" else ["company_key"] for row in corrections.REOPENINGS})
    before = _files(root)
    rewritten = corrections.reopen_register_partitions(spark, root, 2, "7", date(2024, 1, 15))
    expected = corrections.reopen_register(tables, 2, "7", date(2024, 1, 15))
    for name, frame in expected.items():
        found = spark.read.parquet(f"{root}/{name}").select(*frame.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, frame.collect()))
    gone = {file for file in before if not file.exists()}
    assert 0 < len({file.parent for file in gone}) == sum(rewritten.values()) < len({file.parent for file in before})
    assert all("company_key=2" in str(file) for file in gone)


def test_descriptions_rewrite_the_documents_partitions_only(spark, tmp_path):
    tables, root = RegisterTables(spark, SF), str(tmp_path)
    _stored(spark, root, tables, {"erp_document": ["_bucket"], "erp_document_detail": ["_bucket"]})
    before = _files(root)
    rewritten = corrections.propagate_closure_descriptions_partitions(spark, root, tables, 2, "7")
    for name, frame in zip(("erp_document", "erp_document_detail"), corrections.propagate_closure_descriptions(tables, 2, "7")):
        found = spark.read.parquet(f"{root}/{name}").select(*frame.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, frame.collect()))
    touched = {file.parent for file in before if not file.exists()}
    assert len(touched) == sum(rewritten.values()) < len({file.parent for file in before})


def test_rebuild_returns_what_it_could_not_read(spark):
    rebuilt, rejects = closures.rebuild_closures(OddTables(spark, SF))
    assert rebuilt.count() > 0
    assert {tuple(row.payloads) for row in rejects.collect()} >= {("invoice_payment_types",), ("invoice_taxes",)}


def test_the_last_of_a_repeated_key_counts(spark):
    payload = '[{"paymentTypeCode":"1","invoicePaymentValue":1,"invoicePaymentValue":7},{"paymentTypeCode":"2","invoicePaymentValue":3}]'
    rows = spark.createDataFrame([("c", "IN", payload)], "register_closure_id string, invoice_type string, invoice_payment_types string")
    found = {row.payment_type_code: float(row.invoice_payment_value) for row in closures.explode_payments(rows).collect()}
    assert found == {'"1"': 7.0, '"2"': 3.0}


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_one_companys_listing_filters_every_scan_and_leaves_no_copies(spark, tmp_path, whole_plans):
    tables, root = OddTables(spark, SF), str(tmp_path / "stored")
    for name in ("erp_item", "erp_inventory", "erp_inventory_detail", "erp_warehouse"):
        tables[name].write.parquet(f"{root}/{name}")
    stored = {name: spark.read.parquet(f"{root}/{name}") for name in ("erp_item", "erp_inventory", "erp_inventory_detail", "erp_warehouse")}
    broken = inventory.broken_serials(stored, 1)
    plan = inventory.flow_rows(stored, broken, 1)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "company_key" in line]
    assert scans and all("EqualTo(company_key,1)" in line for line in scans)
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    inventory.write_serial_inventory_flow(stored, str(tmp_path / "listing"), 1)
    assert set(shared.iterdir()) == before
    assert spark.read.parquet(str(tmp_path / "listing")).count() == inventory.flow_rows(stored, broken, 1).count()


def test_one_companys_contacts_read_its_deals_only(spark, tmp_path, whole_plans):
    tables, root, names = SampleTables(spark, SF), str(tmp_path), ("crm_deals", "common_person", "crm_origins", "crm_pipelines", "crm_pipeline_stages", "erp_item")
    for name in names:
        tables[name].write.parquet(f"{root}/{name}")
    stored = {name: spark.read.parquet(f"{root}/{name}") for name in names}
    from datetime import datetime

    plan = crm.new_contacts(stored, 1, datetime(1998, 1, 1), datetime(1998, 12, 31))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "deal_name" in line or "FileScan" in line and "person_id#" in line and "crm_deals" in line]
    assert scans and all("EqualTo(company_key,1)" in line for line in scans)


def test_payload_jobs_ask_for_the_session_setting(spark):
    rows = spark.createDataFrame([("c", "IN", "[]")], "register_closure_id string, invoice_type string, invoice_payment_types string")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(ValueError, match="allowDuplicateKeys"):
            closures.explode_payments(rows)
        assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    assert closures.explode_payments(rows).count() == 0

from __future__ import annotations

import re
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlane.plans import corrections, crm, tenants
from ledgerlane.sources.tables import read_tables, union_tenants, with_collation

JAN = (datetime(2023, 1, 1), datetime(2023, 1, 31, 23, 59, 59))


def person(id="p", **values):
    return {
        "id": id,
        "company_key": 1,
        "person_first_name": "Ana",
        "identification_type_name": "CC",
        "person_identification": "12",
        "origin_id": "o",
        "person_created_at": JAN[0],
        **values,
    }


def deal(name="d", **values):
    return {
        "company_key": 1,
        "deal_name": name,
        "amount": D(5),
        "origin_id": "o",
        "pipeline_id": "x",
        "pipeline_stage_id": "won",
        "created_at": JAN[0],
        **values,
    }


@pytest.fixture
def tables(make):
    def build(deals=(), people=()):
        return {
            "crm_deals": make("crm_deals", *deals),
            "common_person": make("common_person", *people),
            "crm_origins": make("crm_origins", {"id": "o", "origin_name": "Web"}),
            "crm_pipelines": make("crm_pipelines", {"id": "x", "pipeline_name": "Ventas"}),
            "crm_pipeline_stages": make(
                "crm_pipeline_stages",
                {"id": "won", "pipeline_stage_name": "Ganado", "is_won": True},
                {"id": "lost", "pipeline_stage_name": "Perdido", "is_won": False},
            ),
            "erp_item": make("erp_item", {"id": "i", "item_name": "Plan A"}),
            "common_person_status": make(
                "common_person_status",
                {"id": "s1", "person_status_name": "Nuevo", "person_status_order": 2},
                {"id": "s2", "person_status_name": "Viejo", "person_status_order": 1},
            ),
            "common_person_state": make(
                "common_person_state", {"id": "t", "person_state_name": "Activo", "person_state_order": 1}
            ),
        }

    return build


def test_won_deals(tables):
    frames = tables(
        [
            deal("none"),
            deal("with", person_id="p", item_id="i"),
            deal("named", person_id="q"),
            deal("unknown-person", person_id="gone"),
            deal("lost", pipeline_stage_id="lost"),
            deal("late", created_at=datetime(2023, 1, 31, 23, 59, 59, 500000)),
            deal("end", created_at=JAN[1]),
            deal("other", company_key=2),
        ],
        [person(), person("q", person_name="Empresa", person_identification_check="7")],
    )
    rows = {row.Nombre: row for row in crm.won_deals(frames, 1, *JAN).collect()}
    assert sorted(rows) == ["end", "named", "none", "unknown-person", "with"]
    assert rows["with"].Contacto == "Ana Ana Ana CC 12"
    assert rows["named"].Contacto == "Empresa CC 12-7"
    assert rows["none"].Contacto == rows["unknown-person"].Contacto == ""
    assert (rows["with"].Plan, rows["none"].Plan, rows["none"].Etapa) == ("Plan A", None, "Ventas: Ganado")
    assert rows["none"]["Valor negocio"] == 5


def test_new_contacts_with_and_without_deals(tables):
    frames = tables(
        [deal("a", person_id="p"), deal("b", person_id="p", pipeline_stage_id="lost"), deal("c")],
        [person(), person("q"), person("old", person_created_at=datetime(2022, 1, 1)), person("x", origin_id=None)],
    )
    rows = crm.new_contacts(frames, 1, *JAN).collect()
    assert sorted((row.Nombre or "", row.Etapa or "") for row in rows) == [
        ("", ""),
        ("a", "Ventas: Ganado"),
        ("b", "Ventas: Perdido"),
    ]
    assert {row.Origen for row in rows} == {"Web"}


def test_leads_in_stage_order(tables):
    people = [
        person("1", person_status_id="s1", person_state_id="t", person_kind="Company"),
        person("2", person_status_id="s2", person_state_id="t"),
        person("3", person_status_id="s1"),
    ]
    rows = crm.leads_with_origin(tables(people=people), 1, *JAN).collect()
    assert [(row.Etapa, row.Tipo, row.Estado) for row in rows] == [
        ("Viejo", "Contacto", "Activo"),
        ("Nuevo", "Empresa", "Activo"),
    ]
    assert rows[0]["Identificación"] == "CC 12"


@pytest.fixture
def ledger(make):
    def build(*closures):
        return {
            "erp_pos_register_closures": make("erp_pos_register_closures", *closures),
            "erp_branch": make("erp_branch", {"id": "b", "branch_name": "Centro"}),
            "erp_pos_registers": make(
                "erp_pos_registers", {"id": "r", "register_name": "Caja 1"}, {"id": "n", "register_name": None}
            ),
            "erp_document": make("erp_document", *[{"id": x, "document_description": "old"} for x in "asrze"]),
            "erp_document_detail": make(
                "erp_document_detail",
                *[
                    {"document_id": x, "document_description": "old", "document_detail_description": "text"}
                    for x in "aassrz"
                ],
            ),
        }

    return build


def linked(**values):
    return {
        "id": "c", "company_key": 1, "branch_id": "b", "register_id": "r", "register_closure_consecutive": 7, **values
    }


def test_descriptions_follow_the_closure(ledger):
    frames = ledger(linked(document_id="s", document_id_advance="a", document_id_refund="r"))
    documents, details = corrections.propagate_closure_descriptions(frames, 1, "r")
    found = {row.id: row.document_description for row in documents.collect()}
    start = "Cierre de caja #7 Centro > Caja 1 - "
    assert found == {"s": start + "Ventas", "a": start + "Anticipos", "r": start + "Devoluciones", "z": "old", "e": "old"}
    rows = {(row.document_id, row.document_description, row.document_detail_description) for row in details.collect()}
    assert ("s", start + "Ventas", None) in rows and ("z", "old", "text") in rows
    assert details.count() == 6


def test_last_link_wins_and_documents_without_details_stay(ledger):
    frames = ledger(linked(document_id="s", document_id_refund="s", document_id_advance="e"))
    documents, _ = corrections.propagate_closure_descriptions(frames)
    found = {row.id: row.document_description for row in documents.collect()}
    assert found["s"].endswith("Devoluciones") and found["e"] == "old"


def test_missing_part_makes_the_description_null(ledger):
    frames = ledger(linked(register_id="n", document_id="s"), linked(company_key=2, document_id="a"))
    documents, details = corrections.propagate_closure_descriptions(frames, company_key=1)
    assert {row.id: row.document_description for row in documents.collect()}["s"] is None
    assert documents.where("document_description = 'old'").count() == 4
    assert details.where("document_id = 's' AND document_description IS NULL").count() == 2


def test_reopen_register(make):
    on, old = date(2024, 3, 13), date(2024, 3, 12)
    key = {"company_key": 1, "register_id": "r"}
    frames = {
        "erp_pos_invoice": make(
            "erp_pos_invoice",
            {**key, "id": "closed", "invoice_status": "CL", "invoice_date": on},
            {**key, "id": "old", "invoice_status": "CL", "invoice_date": old},
            {**key, "id": "open", "invoice_status": "OP", "invoice_date": on},
            {**key, "id": "other", "register_id": "x", "invoice_status": "CL", "invoice_date": on},
        ),
        "erp_pos_credit_notes": make(
            "erp_pos_credit_notes", {**key, "credit_note_is_closed": True, "credit_note_date": on}
        ),
        "erp_pos_advances": make("erp_pos_advances", {**key, "advance_is_closed": None, "advance_date": on}),
        "erp_pos_expenses": make(
            "erp_pos_expenses", {**key, "expense_is_readonly": True, "expense_date_time": datetime(2024, 3, 13)}
        ),
    }
    opened = corrections.reopen_register(frames, 1, "r", on)
    states = {row.id: row.invoice_status for row in opened["erp_pos_invoice"].collect()}
    assert states == {"closed": "PD", "old": "CL", "open": "OP", "other": "CL"}
    assert opened["erp_pos_credit_notes"].first().credit_note_is_closed is False
    assert opened["erp_pos_advances"].first().advance_is_closed is None
    assert opened["erp_pos_expenses"].first().expense_is_readonly is False
    counts = {row.table_name: row.changed for row in corrections.reopen_counts(frames, 1, "r", on).collect()}
    assert counts == {
        "erp_pos_invoice": 1, "erp_pos_credit_notes": 1, "erp_pos_advances": 0, "erp_pos_expenses": 1
    }


@pytest.fixture
def by_tenant(spark):
    frames = {
        "erp_1001": spark.createDataFrame([("1", "x", '[{"a": 1, "b": 2}, 5]')], "id string, extra string, pay string"),
        "erp_1002": spark.createDataFrame([("1", '[{"a": 1}]'), ("2", "[oops")], "id string, pay string"),
        "erp_1003": spark.createDataFrame([("3", "y", None)], "id string, extra string, pay string"),
    }
    return union_tenants(frames)


def pairs(df):
    return sorted(tuple(row) for row in df.collect())


def test_column_drift(by_tenant):
    assert pairs(tenants.column_drift(by_tenant)) == [("erp_1002", "extra", 2), ("erp_1003", "pay", 2)]
    assert pairs(tenants.column_drift(by_tenant, present_in="erp_1001", missing_in="erp_1002")) == [
        ("erp_1001", "erp_1002", "extra")
    ]
    assert pairs(tenants.column_drift(by_tenant, present_in="erp_1002", missing_in="erp_1001")) == []
    with pytest.raises(ValueError):
        tenants.column_drift(by_tenant, present_in="erp_1001")


def test_payload_key_drift(by_tenant):
    assert pairs(tenants.payload_key_drift(by_tenant, "pay")) == [
        ("erp_1002", "b", 1),
        ("erp_1003", "a", 2),
        ("erp_1003", "b", 1),
    ]
    between = tenants.payload_key_drift(by_tenant, "pay", present_in="erp_1001", missing_in="erp_1002")
    assert pairs(between) == [("erp_1001", "erp_1002", "b")]


def test_find_by_id_over_tenants(by_tenant, spark):
    assert pairs(tenants.find_by_id(by_tenant, ["1"]).select("tenant_db", "id")) == [("erp_1001", "1"), ("erp_1002", "1")]
    ids = spark.createDataFrame([("3",), ("9",)], "wanted string")
    assert pairs(tenants.find_by_id(by_tenant, ids).select("tenant_db", "id")) == [("erp_1003", "3")]


def test_tenant_partitions_are_pruned(by_tenant, spark, tmp_path):
    by_tenant.select("tenant_db", "id").write.partitionBy("tenant_db").parquet(f"{tmp_path}/erp_branch")
    frame = read_tables(spark, str(tmp_path), ["erp_branch"], tenants=["erp_1002"])["erp_branch"]
    assert pairs(frame.select("id")) == [("1",), ("2",)]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*tenant_db#\d+ = erp_1002", plan)


def test_collation_ignores_case_and_accents(spark):
    frame = with_collation(spark.createDataFrame([("Válida", 1)], "state string, n int"), "UNICODE_CI_AI")
    assert frame.where(F.col("state") == "VALIDA").count() == 1


def test_results_do_not_depend_on_the_session_time_zone(spark, tables):
    frames = tables([deal("first"), deal("end", created_at=JAN[1])])
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        assert {row.Nombre for row in crm.won_deals(frames, 1, *JAN).collect()} == {"first", "end"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

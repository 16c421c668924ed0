"""CRM reports. Headings are part of the reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.conditions import every, for_company, moment
from ledgerlane.functions.labels import contact, identification
from ledgerlane.operators.lookup import lookup
from ledgerlane.sources.tables import Tables

# Person kind of a company and the two labels.
COMPANY_KIND = "Company"
COMPANY_LABEL, CONTACT_LABEL = "Empresa", "Contacto"


def _between(column: str, from_ts: datetime, to_ts: datetime) -> Column:
    """Inclusive on both ends; an end of 23:59:59 leaves out the last fraction of a second."""
    return F.col(column).between(moment(from_ts), moment(to_ts))


def _contact() -> Column:
    return contact(
        F.col("id"),
        F.col("person_name"),
        F.col("person_first_name"),
        F.col("person_second_name"),
        F.col("identification_type_name"),
        F.col("person_identification"),
        F.col("person_identification_check"),
    ).alias("contact")


def _people(tables: Tables) -> DataFrame:
    return tables["common_person"].select(F.col("id").alias("contact_id"), _contact())


def _plans(tables: Tables) -> DataFrame:
    return tables["erp_item"].select(F.col("id").alias("plan_id"), F.col("item_name").alias("plan"))


def _origins(tables: Tables) -> DataFrame:
    return tables["crm_origins"].select(F.col("id").alias("origin_id"), "origin_name")


def _stages(tables: Tables, won_only: bool) -> DataFrame:
    stages = tables["crm_pipeline_stages"]
    stages = stages.where("is_won") if won_only else stages
    return stages.select(F.col("id").alias("pipeline_stage_id"), "pipeline_stage_name")


def _pipelines(tables: Tables) -> DataFrame:
    return tables["crm_pipelines"].select(F.col("id").alias("pipeline_id"), "pipeline_name")


def _deal_report(df: DataFrame, who: Column) -> DataFrame:
    return df.select(
        F.col("deal_name").alias("Nombre"),
        who.alias("Contacto"),
        F.col("plan").alias("Plan"),
        F.col("amount").alias("Valor negocio"),
        F.col("origin_name").alias("Origen"),
        F.concat("pipeline_name", F.lit(": "), "pipeline_stage_name").alias("Etapa"),
        F.col("created_at").alias("Creado"),
    )


def won_deals(tables: Tables, company_key: int | None, from_ts: datetime, to_ts: datetime) -> DataFrame:
    """Deals created in the period that stand in a won stage, with contact, plan, origin and stage.

    The stage, pipeline and origin catalogues are small and broadcast by their size; deals without a contact or plan are
    spread over all tasks.
    """
    tests = [*for_company(company_key, F.col("company_key")), _between("created_at", from_ts, to_ts)]
    deals = (
        tables["crm_deals"]
        .where(every(tests))
        .join(_stages(tables, won_only=True), "pipeline_stage_id")
        .join(_origins(tables), "origin_id")
        .join(_pipelines(tables), "pipeline_id")
    )
    deals = lookup(deals, "person_id", _people(tables), "contact_id")
    deals = lookup(deals, "item_id", _plans(tables), "plan_id")
    return _deal_report(deals, F.coalesce("contact", F.lit("")))


def new_contacts(tables: Tables, company_key: int | None, from_ts: datetime, to_ts: datetime) -> DataFrame:
    """Contacts created in the period with their origin and, if any, their deals.

    Our reading of an unfinished report: the origin is the person's, and a contact without deals is listed once.
    Contacts with and without deals are two branches, because an outer join could not split a contact that
    holds a large share of all deals, while an inner join can. The first branch names the contacts the second leaves out, so only
    the period's contacts are compared. For one company only that company's deals are read.
    """
    tests = [*for_company(company_key, F.col("company_key")), _between("person_created_at", from_ts, to_ts)]
    people = (
        tables["common_person"]
        .where(every(tests))
        .select(F.col("id").alias("contact_id"), _contact(), "origin_id")
        .join(_origins(tables), "origin_id")
        .drop("origin_id")
    )
    deals = (
        tables["crm_deals"]
        .where(every(for_company(company_key, F.col("company_key"))))
        .select("deal_name", "amount", "pipeline_id", "pipeline_stage_id", "item_id", "created_at", "person_id")
    )
    with_deals = deals.join(people, F.col("person_id") == F.col("contact_id"))
    holders = with_deals.select("contact_id").distinct()
    with_deals = lookup(with_deals, "pipeline_id", _pipelines(tables).withColumnRenamed("pipeline_id", "_p"), "_p")
    stages = _stages(tables, won_only=False).withColumnRenamed("pipeline_stage_id", "_s")
    with_deals = lookup(with_deals, "pipeline_stage_id", stages, "_s")
    with_deals = lookup(with_deals, "item_id", _plans(tables), "plan_id")

    without_deals = people.join(holders, "contact_id", "left_anti")
    return _deal_report(
        with_deals.unionByName(without_deals, allowMissingColumns=True), F.col("contact")
    )


def leads_with_origin(tables: Tables, company_key: int | None, from_ts: datetime, to_ts: datetime) -> DataFrame:
    """Leads created in the period with origin, stage and state, by stage order and then state order.

    The person id ends the sort key: it makes the order stable and lets the range sort split a stage that
    holds most leads.
    """
    tests = [
        *for_company(company_key, F.col("company_key")),
        F.col("person_state_id").isNotNull(),
        _between("person_created_at", from_ts, to_ts),
    ]
    stages = tables["common_person_status"].withColumnRenamed("id", "person_status_id")
    states = tables["common_person_state"].withColumnRenamed("id", "person_state_id")
    leads = (
        tables["common_person"]
        .where(every(tests))
        .join(stages, "person_status_id")
        .join(states, "person_state_id")
        .join(_origins(tables), "origin_id")
        .orderBy("person_status_order", "person_state_order", "id")
    )
    return leads.select(
        identification(
            F.col("identification_type_name"), F.col("person_identification"), F.col("person_identification_check")
        ).alias("Identificación"),
        F.col("person_name").alias("Razón social (nombre)"),
        F.col("origin_name").alias("Origen"),
        F.when(F.col("person_kind") == COMPANY_KIND, COMPANY_LABEL).otherwise(CONTACT_LABEL).alias("Tipo"),
        F.col("person_status_name").alias("Etapa"),
        F.col("person_state_name").alias("Estado"),
    )

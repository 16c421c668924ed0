"""Bulk corrections.

Each comes twice: as a plan that returns whole corrected tables, for small tables and for new published versions, and as a job over
stored, partitioned tables that reads and rewrites only the partitions holding a row to correct.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.conditions import every
from ledgerlane.sources.publish import rewrite_partitions, scratch_scope, store
from ledgerlane.sources.tables import Tables

# Closure column linking a document, and the word its description ends with, in the order applied.
DOCUMENT_LINKS = (
    ("document_id", "Ventas"),
    ("document_id_advance", "Anticipos"),
    ("document_id_refund", "Devoluciones"),
)

# Invoice states of a closed and a re-opened sale.
CLOSED, REOPENED = "CL", "PD"


def _register(company_key: int | None, register_id: str | None) -> list[Column]:
    tests = []
    if company_key is not None:
        tests.append(F.col("company_key") == company_key)
    if register_id is not None:
        tests.append(F.col("register_id") == register_id)
    return tests


def closure_descriptions(tables: Tables, company_key: int | None = None, register_id: str | None = None) -> DataFrame:
    """Document id and new description for every document linked from the closures of a register.

    A document linked more than once gets the description of the last link applied; among closures with the same link the
    highest closure number decides. A missing part makes the description NULL.
    """
    branches = tables["erp_branch"].select(F.col("id").alias("branch_id"), "branch_name")
    registers = tables["erp_pos_registers"].select(F.col("id").alias("register_id"), "register_name")
    closures = (
        tables["erp_pos_register_closures"]
        .where(every(_register(company_key, register_id)))
        .join(branches, "branch_id")
        .join(registers, "register_id")
    )
    links = F.array(
        *[
            F.struct(F.col(column).alias("document_id"), F.lit(rank).alias("rank"), F.lit(word).alias("word"))
            for rank, (column, word) in enumerate(DOCUMENT_LINKS)
        ]
    )
    described = closures.withColumn("link", F.explode(links)).select(
        F.col("link.document_id").alias("document_id"),
        F.struct("link.rank", "register_closure_consecutive", "id").alias("applied"),
        F.concat(
            F.lit("Cierre de caja #"),
            F.col("register_closure_consecutive").cast("string"),
            F.lit(" "),
            "branch_name",
            F.lit(" > "),
            "register_name",
            F.lit(" - "),
            "link.word",
        ).alias("description"),
    )
    return (
        described.where(F.col("document_id").isNotNull())
        .groupBy("document_id")
        .agg(F.max_by(F.struct("description"), "applied")["description"].alias("description"))
    )


def propagate_closure_descriptions(
    tables: Tables, company_key: int | None = None, register_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents and document details with the descriptions taken from their register closure.

    Only documents with details are touched. Details get their document's description and lose their own.
    The patch has one row per document; the planner broadcasts it when it is small.
    """
    documents, details = tables["erp_document"], tables["erp_document_detail"]
    patch = closure_descriptions(tables, company_key, register_id)
    known = patch.join(documents.select(F.col("id").alias("document_id")), "document_id")
    detailed = details.select("document_id").join(known, "document_id").distinct()

    mark = detailed.select(F.col("document_id").alias("_document"), F.struct("description").alias("_new"))
    hit = F.col("_new").isNotNull()
    new_documents = documents.join(mark, F.col("id") == F.col("_document"), "left").withColumn(
        "document_description", F.when(hit, F.col("_new.description")).otherwise(F.col("document_description"))
    )
    known_mark = known.select(F.col("document_id").alias("_document"), F.struct("description").alias("_new"))
    new_details = details.join(known_mark, F.col("document_id") == F.col("_document"), "left").withColumns(
        {
            "document_description": F.when(hit, F.col("_new.description")).otherwise(F.col("document_description")),
            "document_detail_description": F.when(~hit, F.col("document_detail_description")),
        }
    )
    return new_documents.select(*documents.columns), new_details.select(*details.columns)


# Table, date column, flag or state column, value that is re-opened, value it gets.
REOPENINGS = (
    ("erp_pos_invoice", "invoice_date", "invoice_status", CLOSED, REOPENED),
    ("erp_pos_credit_notes", "credit_note_date", "credit_note_is_closed", True, False),
    ("erp_pos_advances", "advance_date", "advance_is_closed", True, False),
    ("erp_pos_expenses", "expense_date_time", "expense_is_readonly", True, False),
)


def _reopened(row: tuple, company_key: int, register_id: str, date_from: date) -> Column:
    _, on, state, old, _ = row
    tests = _register(company_key, register_id)
    return every([*tests, F.col(state) == old, F.col(on) >= F.lit(date_from)])


def reopen_register(tables: Tables, company_key: int, register_id: str, date_from: date) -> dict[str, DataFrame]:
    """The four POS tables with the records of one register re-opened from a day on. No shuffle: one projection each."""
    return {
        row[0]: tables[row[0]].withColumn(
            row[2],
            F.when(_reopened(row, company_key, register_id, date_from), F.lit(row[4])).otherwise(F.col(row[2])),
        )
        for row in REOPENINGS
    }


def _partitions_of(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a stored table, from the first folder names below it."""
    table = spark.read.parquet(path)
    named = table.select(F.input_file_name().alias("file")).limit(1).collect()
    inside = named[0].file.split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1] if named else ""
    return [part.split("=")[0] for part in inside.split("/")[:-1] if "=" in part]


def reopen_register_partitions(spark: SparkSession, root: str, company_key: int, register_id: str, date_from: date) -> dict[str, int]:
    """Re-open one register's records in the tables stored under ``root``; returns how many partitions of each were rewritten."""
    rewritten = {}
    for row in REOPENINGS:
        name, _, state, _, new = row
        path, hit = f"{root}/{name}", _reopened(row, company_key, register_id, date_from)
        change = F.when(hit, F.lit(new)).otherwise(F.col(state))
        rewritten[name] = rewrite_partitions(
            spark, path, lambda df, h=hit: df.where(h), lambda df, c=change, s=state: df.withColumn(s, c), _partitions_of(spark, path)
        )
    return rewritten


def propagate_closure_descriptions_partitions(
    spark: SparkSession, root: str, tables: Tables, company_key: int | None = None, register_id: str | None = None
) -> dict[str, int]:
    """Write the descriptions of a register's closures into the documents and details stored under ``root``.

    Documents and details are looked up by the ids of the register's closures only. ``tables`` gives the closures and catalogues.
    """
    with scratch_scope(spark):
        patch = store(closure_descriptions(tables, company_key, register_id), "descriptions")
        documents = spark.read.parquet(f"{root}/erp_document")
        known = patch.join(documents.select(F.col("id").alias("document_id")), "document_id")
        details = spark.read.parquet(f"{root}/erp_document_detail").select("document_id")
        detailed = store(details.join(known, "document_id").distinct(), "descriptions-detailed")
        known = store(known, "descriptions-known")
        rewritten = {}
        for name, key, marks in (("erp_document", "id", detailed), ("erp_document_detail", "document_id", known)):
            path = f"{root}/{name}"
            mark = marks.select(F.col("document_id").alias("_document"), F.struct("description").alias("_new"))

            def change(df: DataFrame, key: str = key, mark: DataFrame = mark) -> DataFrame:
                hit = F.col("_new").isNotNull()
                described = df.join(mark, F.col(key) == F.col("_document"), "left")
                changed = {"document_description": F.when(hit, F.col("_new.description")).otherwise(F.col("document_description"))}
                if key == "document_id":
                    changed["document_detail_description"] = F.when(~hit, F.col("document_detail_description"))
                return described.withColumns(changed)

            def touched(df: DataFrame, key: str = key, mark: DataFrame = mark) -> DataFrame:
                return df.join(mark, F.col(key) == F.col("_document"), "left_semi")

            rewritten[name] = rewrite_partitions(spark, path, touched, change, _partitions_of(spark, path))
    return rewritten


def reopen_counts(tables: Tables, company_key: int, register_id: str, date_from: date) -> DataFrame:
    """How many rows of each table :func:`reopen_register` changes."""
    counts = [
        tables[row[0]]
        .where(_reopened(row, company_key, register_id, date_from))
        .agg(F.count("*").alias("changed"))
        .select(F.lit(row[0]).alias("table_name"), "changed")
        for row in REOPENINGS
    ]
    return reduce(DataFrame.unionByName, counts)

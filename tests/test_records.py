"""Schemaless differences, record hashes, tenants of unequal types, ragged combinations, ids, collations, buckets, blocks of time."""

from __future__ import annotations

import itertools
import json
import random
import uuid
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ids
from ledgerlane.operators.combinations import ragged_combinations, ragged_counts
from ledgerlane.operators.diff import changed_records, record_hash, snapshot_diff
from ledgerlane.operators.interval import day_spans, join_intervals
from ledgerlane.plans import closures, sales
from ledgerlane.sources import collation
from ledgerlane.sources.bucketed import bucketed_copies
from ledgerlane.sources.odd_sample import OddTables
from ledgerlane.sources.reconcile import common_type, reading_plan, reconciled, stored_schemas, type_drift
from ledgerlane.sources.sample import SampleTables
from ledgerlane.sources.tables import read_tables

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Schemaless records --------------------------------------------------------------------------------------------------


def records(spark, *rows):
    """(id, v VARIANT) from JSON texts; None is no value."""
    return spark.createDataFrame([(k, text) for k, text in enumerate(rows)], "id long, t string").select("id", F.try_parse_json("t").alias("v"))


def differences(spark, left, right):
    found = snapshot_diff(records(spark, *left), records(spark, *right), ["id"]).collect()
    return sorted((row.id, row.path, row.left, row.right) for row in found)


def plain_differences(path, left, right):
    """Two parsed values, walked down together; ... stands for none."""
    if isinstance(left, dict) and isinstance(right, dict):
        for name in {**left, **right}:
            step = f"`{name}`" if "." in name else name
            yield from plain_differences(f"{path}.{step}", left.get(name, ...), right.get(name, ...))
    elif isinstance(left, list) and isinstance(right, list):
        for place, (a, b) in enumerate(itertools.zip_longest(left, right, fillvalue=...)):
            yield from plain_differences(f"{path}.{place}", a, b)
    elif type(left) is not type(right) or left != right:
        yield path, *(None if v is ... else json.dumps(v, sort_keys=True, separators=(",", ":")) for v in (left, right))


def drawn(draw, depth=4):
    kind = draw.randint(0, 7 if depth else 4)
    if kind > 5:
        return [drawn(draw, depth - 1) for _ in range(draw.randint(0, 3))]
    if kind > 3 and depth:
        return {name: drawn(draw, depth - 1) for name in draw.sample(["a", "b", "c.d", "e"], draw.randint(0, 4))}
    return draw.choice([None, True, False, 1, 2, -7, "x", "1", "true", ""])


def test_schemaless_differences_equal_a_plain_walk(spark):
    draw = random.Random(4)
    pairs = [(drawn(draw), drawn(draw)) for _ in range(150)] + [({"k": drawn(draw), "l": 1}, {"l": 1, "k": drawn(draw)}) for _ in range(150)]
    found = differences(spark, *([json.dumps(pair[side]) for pair in pairs] for side in (0, 1)))
    expected = [(k, *entry) for k, (a, b) in enumerate(pairs) for entry in plain_differences("v", a, b)]
    assert found == sorted(expected, key=lambda row: (row[0], row[1]))
    assert differences(spark, *[[json.dumps(a) for a, _ in pairs]] * 2) == []


def test_order_of_names_and_spelling_of_numbers_are_no_difference(spark):
    assert differences(spark, ['{"a":1,"b":{"c":2,"d":[1.0,100]}}'], ['{"b":{"d":[1,1e2],"c":2.00},"a":1}']) == []


def test_null_missing_empty_and_malformed(spark):
    left = ['{"a":null}', '{"a":{}}', '{"a":[]}', "{", None, '{"a":{"b":1}}', "[1,2]"]
    right = ["{}", '{"a":[]}', '{"a":[[]]}', '{"a":1}', None, '{"a":null}', '{"0":1}']
    assert differences(spark, left, right) == [
        (0, "v.a", "null", None),
        (1, "v.a", "{}", "[]"),
        (2, "v.a.0", None, "[]"),
        (3, "v", None, '{"a":1}'),
        (5, "v.a", '{"b":1}', "null"),
        (6, "v", "[1,2]", '{"0":1}'),
    ]


def test_deep_and_wide_records(spark):
    deep = ["[" * 40 + end + "]" * 40 for end in ("1", "2")]
    assert [(path.count("."), left, right) for _, path, left, right in differences(spark, deep[:1], deep[1:])] == [(40, "1", "2")]
    wide = [json.dumps({f"k{n}": n * (n % 100 != side) for n in range(5000)}) for side in (200, 7)]
    assert len(differences(spark, wide[:1], wide[1:])) == 50


def test_schemaless_columns_beside_typed_ones_and_inside_them(spark):
    def frame(v, x, inner, gone=None):
        text = spark.range(1).select("id", F.parse_json(F.lit(v)).alias("v"), F.lit(x).alias("x"), F.struct(F.parse_json(F.lit(inner)).alias("w")).alias("s"))
        return text if gone is None else text.withColumn("gone", F.parse_json(F.lit(gone)))

    found = snapshot_diff(frame('{"a":1}', 5, '{"p":1,"q":2}', "[1]"), frame('{"a":2}', 6, '{"q":2,"p":1}'), ["id"]).collect()
    assert sorted((r.path, r.left, r.right) for r in found) == [("gone", "[1]", None), ("v.a", "1", "2"), ("x", "5", "6")]


def test_schemaless_differences_of_nothing(spark):
    assert differences(spark, [], []) == []


# Record hashes ---------------------------------------------------------------------------------------------------------


def test_hash_ignores_orders_and_nothing_else(spark):
    first = spark.sql("SELECT 1 AS id, 'x' AS a, named_struct('p', 1, 'q', map('k', 1, 'l', 2)) AS s, array(1, 2) AS l, parse_json('{\"a\":1,\"b\":2}') AS v")
    same = spark.sql("SELECT parse_json('{\"b\":2,\"a\":1}') AS v, array(1, 2) AS l, named_struct('q', map('l', 2, 'k', 1), 'p', 1) AS s, 'x' AS a, 1 AS id, null AS extra")
    others = [
        same.withColumn("l", F.array(F.lit(2), F.lit(1))),
        same.withColumn("a", F.lit("y")),
        same.withColumn("id", F.lit(1).cast("long")),
        same.withColumn("extra", F.lit("")),
        same.drop("a").withColumn("b", F.lit("x")),
        same.withColumn("v", F.parse_json(F.lit('{"a":"1","b":2}'))),
    ]
    hashes = [df.select(record_hash(df).alias("h")).first().h for df in (first, same, *others)]
    assert hashes[0] == hashes[1] and len(set(hashes)) == len(others) + 1


def test_text_of_fields_does_not_run_together(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab", None), (None, "ab")], "x string, y string")
    assert rows.select(record_hash(rows).alias("h")).distinct().count() == 4


@pytest.mark.parametrize("kind", ["flat", "nested", "restructured"])
def test_differences_by_hash_are_the_same(spark, kind):
    sample, odd = SampleTables(spark, SF), OddTables(spark, SF)
    sides = {
        "flat": (sample.customers(), sample.customers(changed=True)),
        "nested": (sample.customers(nested=True), sample.customers(changed=True, nested=True)),
        "restructured": (odd.restructured_customers(), odd.restructured_customers(changed=True)),
    }[kind]
    found = [sorted(map(str, snapshot_diff(*sides, ["c_custkey"], by_hash=by_hash).collect())) for by_hash in (False, True)]
    assert found[0] == found[1] and found[0]


def test_only_keys_and_hashes_are_shuffled_to_find_changed_records(spark):
    left = spark.range(1000).selectExpr("id", "repeat('wide', 100) AS text", "id AS other")
    right = left.withColumn("other", F.when(F.col("id") == 5, 0).otherwise(F.col("other")))
    plans = [physical(frame) for frame in changed_records(left, right, ["id"])]
    assert all("BroadcastHashJoin" in plan and "hashpartitioning" not in plan for plan in plans)
    assert [frame.count() for frame in changed_records(left, right, ["id"])] == [1, 1]


# Tenants of unequal types ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "kinds, common",
    [
        ("int, bigint", "bigint"),
        ("tinyint, int", "int"),
        ("int, decimal(5,2)", "decimal(12,2)"),
        ("bigint, decimal(20,6)", "decimal(25,6)"),
        ("decimal(38,0), decimal(10,4)", "string"),
        ("int, double", "double"),
        ("bigint, double", "string"),
        ("decimal(5,2), double", "string"),
        ("date, timestamp_ntz", "timestamp_ntz"),
        ("date, string", "string"),
        ("boolean, int", "string"),
        ("array<int>, string", "string"),
        ("int, bigint, string", "string"),
        ("int", "int"),
    ],
)
def test_lattice(kinds, common):
    found = [T.StructType.fromDDL(", ".join(f"`c{k}` {kind}" for k, kind in enumerate(_split(kinds)))).fields[k].dataType for k in range(len(_split(kinds)))]
    assert common_type(found).simpleString() == common == common_type(found[::-1]).simpleString()


def _split(kinds):
    return [kind.strip() for kind in kinds.replace(", ", "|").split("|")]


def stored(spark, root, **tenants):
    for tenant, sql in tenants.items():
        spark.sql(sql).write.mode("append").parquet(f"{root}/tenant_db={tenant}")
    return root


def test_unequal_types_are_read_and_nothing_is_lost_silently(spark, tmp_path):
    root = stored(spark, str(tmp_path / "t"), a="SELECT 1 AS id, 1.5D AS x, 'n' AS own", b="SELECT 2L AS id, '7' AS x", c="SELECT 'z' AS id, 'oops' AS x")
    with pytest.raises(Exception, match="MERGE"):
        spark.read.option("mergeSchema", "true").parquet(root).collect()
    read = reconciled(spark, reading_plan(spark, root, T.StructType.fromDDL("x decimal(10,2)")))
    assert dict(read.frame.drop("tenant_db").dtypes) == {"id": "string", "x": "decimal(10,2)", "own": "string"}
    assert sorted(map(tuple, read.frame.select("tenant_db", "id", "x", "own").collect())) == [
        ("a", "1", Decimal("1.50"), "n"),
        ("b", "2", Decimal("7.00"), None),
        ("c", "z", None, None),
    ]
    assert [tuple(row) for row in read.lost.collect()] == [("c", "x", "string", "oops", 1)]


def test_one_tenant_whose_files_disagree(spark, tmp_path):
    root = stored(spark, str(tmp_path / "t"), a="SELECT 1 AS id", b="SELECT 5 AS id")
    stored(spark, root, a="SELECT '2' AS id")
    assert sorted(len(s.paths) for s in stored_schemas(spark, root)) == [1, 2]
    plan = reading_plan(spark, root)
    assert sorted(row.id for row in reconciled(spark, plan).frame.collect()) == ["1", "2", "5"]
    assert sorted((r.tenant, r.stored_type, r.filled) for r in type_drift(spark, plan).collect()) == [("a", "int", 1), ("a", "string", 1), ("b", "int", 1)]


def test_equal_types_are_no_drift_and_tenants_prune(spark, tmp_path):
    root = stored(spark, str(tmp_path / "t"), a="SELECT 1 AS id", b="SELECT 2 AS id, 'x' AS more")
    plan = reading_plan(spark, root)
    assert type_drift(spark, plan).count() == 0 and reconciled(spark, plan).lost.count() == 0
    assert [tuple(s.schema.names) for s in reading_plan(spark, root, tenants=["a"]).stored] == [("id",)]


def test_tables_read_with_reconciled_types(spark, tmp_path, make):
    make("erp_invoice", {"id": "1", "company_key": 3}).write.parquet(f"{tmp_path}/erp_invoice/tenant_db=a")
    make("erp_invoice", {"id": "2", "company_key": 4}).withColumn("company_key", F.lit("4")).write.parquet(f"{tmp_path}/erp_invoice/tenant_db=b")
    frame = read_tables(spark, str(tmp_path), ["erp_invoice"], reconcile=True)["erp_invoice"]
    assert sorted((row.id, row.company_key) for row in frame.collect()) == [("1", 3), ("2", 4)] and dict(frame.dtypes)["company_key"] == "int"


# Ragged combinations -----------------------------------------------------------------------------------------------------


def test_ragged_combinations_equal_products(spark):
    lists = {"none": [], "one": [["a", "b"]], "five": [["x"], ["1", "2"], ["p", "q", "r"], ["m", "n"], ["y", "z"]], "hole": [["a"], []], "long": [[str(n) for n in range(400)]] * 2}
    axes = [(product, None if not own else k, None if not own else f"axis{9 - k}") for product, own in lists.items() for k in (range(len(own)) if own else [0])]
    options = [(product, f"axis{9 - k}", 3 * p + 1, value) for product, own in lists.items() for k, values in enumerate(own) for p, value in enumerate(values)]
    frames = spark.createDataFrame(axes, "product string, axis_no int, axis string"), spark.createDataFrame(options, "product string, axis string, pos int, value string")
    found = {}
    for row in ragged_combinations(*frames).collect():
        found.setdefault(row.product, {})[row.ordinal] = tuple(row.combination)
    expected = {product: list(itertools.product(*own)) for product, own in lists.items()}
    assert {product: [rows[k] for k in range(len(rows))] for product, rows in found.items()} == {p: rows for p, rows in expected.items() if rows}
    counts = {row.product: (row.axes, row.combinations) for row in ragged_counts(*frames).collect()}
    assert counts == {product: (len(own), len(expected[product])) for product, own in lists.items()}


# Ids -----------------------------------------------------------------------------------------------------------------------


def test_ids_are_version_5_uuids(spark):
    names = ["", "a", "ñandú", "x" * 500]
    rows = spark.createDataFrame([(name,) for name in names], "name string").select("name", ids.uuid5(uuid.NAMESPACE_URL, F.col("name")).alias("id")).collect()
    assert {row.name: row.id for row in rows} == {name: str(uuid.uuid5(uuid.NAMESPACE_URL, name)) for name in names}


def test_ids_follow_the_key_only(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("", "a"), ("aa", ""), ("-", None)], "x string, y string")
    first = {tuple(r)[:2]: r.id for r in rows.withColumn("id", ids.row_id("t", "x", "y")).collect()}
    again = {tuple(r)[:2]: r.id for r in rows.repartition(5).orderBy("y").withColumn("id", ids.row_id("t", "x", "y")).collect()}
    assert first == again and len(set(first.values())) == 6
    assert first[("a", None)] != rows.withColumn("id", ids.row_id("other", "x", "y")).first().id


# Collations ----------------------------------------------------------------------------------------------------------------


def test_the_filter_of_collated_documents_reaches_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    OddTables(spark, SF).spelled_invoices().write.parquet(f"{tmp_path}/invoice")
    frame = sales.eligible_documents_collated(spark.read.parquet(f"{tmp_path}/invoice"), "invoice")
    plan = physical(frame)
    assert "In(document_mode, [PRODUCTION,Prodúction,production])" in plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_many_spellings_give_the_same_rows(spark, monkeypatch):
    rows = spark.createDataFrame([("Anulada", 1), ("ANULADA", 2), ("anuláda", 3), ("x", 4), (None, 5)], "a string, n int")
    found = []
    for limit in (10, 1):
        monkeypatch.setattr(collation, "SPELLINGS", limit)
        found.append(sorted(r.n for r in collation.collated(rows, ["a"], {"a": ["anulada"]}).collect()))
    assert found == [[1, 2, 3]] * 2


def test_collated_joins_and_sums(spark):
    rows = spark.createDataFrame([("É", 1), ("e", 2), ("E", 3), (None, 4), ("f", 5)], "k string, n int")
    other = spark.createDataFrame([("é", "x"), ("F", "y"), (None, "z")], "k string, w string")
    assert sorted((r.k, r.n, r.w) for r in collation.join_collated(rows, other, ["k"]).collect()) == [("E", 3, "x"), ("e", 2, "x"), ("f", 5, "y"), ("É", 1, "x")]
    assert sorted(((r.k, r.n) for r in collation.sum_collated(rows, ["k"], ["n"]).collect()), key=str) == sorted([("E", 6), ("f", 5), (None, 4)], key=str)


# Buckets ---------------------------------------------------------------------------------------------------------------------


def test_bucketed_headers_and_details_join_without_a_shuffle(spark):
    tables, before = SampleTables(spark, SF), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    specs = [sales.KINDS[kind] for kind in sales.ERP_KINDS]
    keys = {spec.table: "id" for spec in specs} | {spec.detail_table: "biz_document_id" for spec in specs}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    with bucketed_copies(spark, tables, keys, buckets=4) as copies:
        lines, report = sales.item_lines(copies), sales.sales_by_item(copies)
        assert physical(lines).count("SortMergeJoin") == 3 and "Exchange" not in physical(lines)
        assert physical(report).count("Exchange hashpartitioning") == 1  # that of the totals
        assert sorted(map(str, report.collect())) == sorted(map(str, sales.sales_by_item(tables).collect()))
        names = list(copies.names.values())
    assert not any(spark.catalog.tableExists(name) for name in names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Blocks of time ----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("by", ["days", "blocks", "auto"])
def test_intervals_of_seconds_and_of_years(spark, by):
    draw, start = random.Random(8), datetime(1969, 6, 1)
    spans = []
    for n in range(60):
        begin = start + timedelta(seconds=draw.randrange(80_000_000))
        length = draw.choice([0, 1, 59, 3600, 86_400, 40 * 86_400, 900 * 86_400])
        spans.append((n, n % 2, begin, begin + timedelta(seconds=length, microseconds=draw.choice([0, 500_000]))))
    spans.append((99, 0, start + timedelta(days=9), start))  # ends before it starts
    points = [(k, k % 2, spans[k % 60][2 + k % 2] + timedelta(microseconds=draw.choice([0, 0, 1, -1, 10**9]))) for k in range(400)]
    intervals = spark.createDataFrame(spans, "span int, k int, a timestamp_ntz, b timestamp_ntz")
    dots = spark.createDataFrame(points, "point int, k int, at timestamp_ntz")
    found = [(row.span, row.point) for row in join_intervals(day_spans(intervals, "a", "b"), dots, ["k"], "at", by).collect()]
    assert sorted(found) == sorted((s, p) for s, k, a, b in spans for p, kk, at in points if k == kk and a <= at <= b)


def test_long_intervals_take_blocks_and_short_ones_days(spark):
    def plan(days):
        a = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
        intervals = spark.range(50).select(F.lit(1).alias("k"), a.alias("a"), F.timestamp_add("DAY", F.lit(days), a).alias("b"))
        dots = spark.range(200).select(F.lit(1).alias("k"), F.timestamp_add("DAY", (F.col("id") * 20).cast("int"), a).alias("at"))
        return physical(join_intervals(day_spans(intervals, "a", "b"), dots, ["k"], "at"))

    assert "_block" in plan(3000) and "_block" not in plan(1)


# Reference lists -----------------------------------------------------------------------------------------------------------------


def test_pieces_make_up_the_list(spark):
    rows = [("c", "IN", None if n % 2 else "1", f'"{n:05d}"') for n in range(2500)] + [("c", "IN", "1", None), ("d", "RF", "2", '"x"'), ("d", "RF", "2", '"x"')]
    payments = spark.createDataFrame(rows, "register_closure_id string, invoice_type string, payment_type_code string, invoice_payment_reference string")
    found = {}
    for row in closures.reference_lists(payments.repartition(5), size=100).orderBy("piece").collect():
        assert row.size <= 100
        found.setdefault((row.register_closure_id, row.payment_type_code), []).extend(json.loads(row.payment_references))
    assert found == {("c", "1"): [f"{n:05d}" for n in range(0, 2500, 2)], ("c", None): [f"{n:05d}" for n in range(1, 2500, 2)], ("d", "2"): ["x", "x"]}

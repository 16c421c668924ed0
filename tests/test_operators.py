from __future__ import annotations

import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators.combinations import combination_counts, combinations
from ledgerlane.operators.diff import snapshot_diff
from ledgerlane.operators import interval
from ledgerlane.operators.interval import day_spans, join_intervals
from ledgerlane.operators.lookup import lookup
from ledgerlane.operators.numbering import number_rows
from ledgerlane.operators.replace import replace_into
from ledgerlane.sources.publish import (
    StaleVersion,
    current_version,
    publish,
    read_current,
    rewrite_partitions,
    scratch_scope,
    shared_folder,
    store,
    upsert_partitions,
    upsert_published,
)
from ledgerlane.plans.tenants import column_drift
from ledgerlane.sources.tables import read_tables

SEED = [["Amarillo", "Blanco"], ["S", "M"], ["Casual", "Deportivo"], ["Camisa", "Camiseta"]]


def options(spark, products: dict[str, list[list[str]]]):
    rows = [
        (product, f"axis{k}", pos, value)
        for product, lists in products.items()
        for k, values in enumerate(lists)
        for pos, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, "product string, axis string, pos int, value string")


def axes(count):
    return [f"axis{k}" for k in range(count)]


def test_combinations_in_list_order(spark):
    rows = combinations(options(spark, {"shirt": SEED}), axes(4)).orderBy("ordinal").collect()
    assert [tuple(row.combination) for row in rows] == list(itertools.product(*SEED))
    assert [row.ordinal for row in rows] == list(range(16))


def test_combinations_of_uneven_products(spark):
    products = {"a": [["1"], ["x", "y", "z"]], "b": [["1", "2", "3"], ["x"]], "no-axis1": [["1", "2"]]}
    found = combinations(options(spark, products), axes(2)).collect()
    for name in ("a", "b"):
        mine = sorted((row.ordinal, tuple(row.combination)) for row in found if row.product == name)
        assert [combination for _, combination in mine] == list(itertools.product(*products[name]))
    assert {row.product for row in found} == {"a", "b"}
    counts = {row["product"]: row.combinations for row in combination_counts(options(spark, products), axes(2)).collect()}
    assert counts == {"a": 3, "b": 3, "no-axis1": 0}


def test_no_axes_give_one_empty_combination(spark):
    (row,) = combinations(options(spark, {"shirt": SEED}), []).collect()
    assert (row["product"], row.ordinal, row.combination) == ("shirt", 0, [])


def test_many_combinations_span_several_chunks(spark):
    lists = [[str(i) for i in range(60)] for _ in range(3)]
    frame = combinations(options(spark, {"p": lists}), axes(3))
    total, distinct, top = frame.agg(F.count("*"), F.countDistinct("combination"), F.max("ordinal")).first()
    assert total == distinct == 60**3 and top == 60**3 - 1


@pytest.mark.parametrize("broadcast_days", [100_000, 0])
def test_interval_join_equals_brute_force(spark, monkeypatch, broadcast_days):
    monkeypatch.setattr(interval, "BROADCAST_DAYS", broadcast_days)
    rng = random.Random(5)
    spans = [(f"i{n}", n % 3, *sorted(rng.sample(range(400), 2))) for n in range(40)]
    points = [(n, rng.randrange(3), rng.randrange(400)) for n in range(300)]

    def hours(name):
        return F.timestamp_add("HOUR", F.col(name), F.lit("2024-02-20 00:00:00").cast("timestamp_ntz")).alias(name)

    intervals = spark.createDataFrame(spans, "span string, k int, a int, b int").select("span", "k", hours("a"), hours("b"))
    dots = spark.createDataFrame(points, "point int, k int, at int").select("point", "k", hours("at"))
    joined = join_intervals(day_spans(intervals, "a", "b"), dots, ["k"], "at")
    assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) is bool(broadcast_days)
    found = {(row.span, row.point) for row in joined.collect()}
    expected = {(s, p) for s, k, a, b in spans for p, kk, at in points if k == kk and a <= at <= b}
    assert found == expected
    assert join_intervals(day_spans(intervals.where("a > b"), "a", "b"), dots, ["k"], "at").count() == 0


def test_a_wrong_date_does_not_lengthen_the_day_list(spark, monkeypatch):
    listed = []
    monkeypatch.setattr(interval.F, "broadcast", lambda df: listed.append(df.count()) or df)
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    intervals = spark.range(1).select(F.lit(1).alias("k"), at("0001-01-01 00:00:00").alias("a"), at("2024-03-05 12:00:00").alias("b"))
    dots = spark.range(3).select(F.lit(1).alias("k"), F.timestamp_add("DAY", F.col("id").cast("int"), at("2024-03-04 11:00:00")).alias("at"))
    assert join_intervals(day_spans(intervals, "a", "b"), dots, ["k"], "at").count() == 2
    assert join_intervals(day_spans(intervals, "a", "b"), dots.limit(0), ["k"], "at").count() == 0
    assert listed == [2, 0]


def test_numbers_are_dense_and_ordered(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(7)
    rows = number_rows(frame, [F.col("v").desc()]).collect()
    assert sorted((row.idx, row.v) for row in rows) == [(i + 1, 4999 - i) for i in range(5000)]
    assert number_rows(frame.where("v < 0"), [F.col("v")]).count() == 0


def test_lookup_spreads_null_keys(spark):
    facts = spark.createDataFrame([(n, None if n % 3 else n) for n in range(300)], "n int, k int")
    table = spark.createDataFrame([(n, f"t{n}") for n in range(0, 150, 3)], "key int, label string")
    rows = lookup(facts, "k", table, "key").collect()
    assert len(rows) == 300
    assert {(row.n, row.label) for row in rows if row.label} == {(n, f"t{n}") for n in range(0, 150, 3)}


def test_replace_by_key(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), (None, 1, 30)], "k string, d int, v int")
    source = spark.createDataFrame([("b", 1, 99), ("c", 2, 5), (None, 1, 31)], "k string, d int, v int")
    once = replace_into(target, source, ["k", "d"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        [("a", 1, 10), ("b", 1, 99), ("c", 2, 5), (None, 1, 30), (None, 1, 31)], key=str
    )
    keyed = source.where("k IS NOT NULL")
    twice = replace_into(replace_into(target, keyed, ["k", "d"]), keyed, ["k", "d"])
    assert sorted(map(str, twice.collect())) == sorted(map(str, replace_into(target, keyed, ["k", "d"]).collect()))


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "report")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    publish(first, root)
    upsert_published(spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), root, ["k"])
    assert sorted(map(tuple, read_current(spark, root).collect())) == [("a", 1), ("b", 9), ("c", 3)]
    assert current_version(spark, root)[0] == 2
    first.write.parquet(f"{root}/data/99999999-uncommitted")
    assert read_current(spark, root).count() == 3


def test_first_upsert_creates_and_stale_commits_are_refused(spark, tmp_path):
    root = str(tmp_path / "report")
    rows = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(FileNotFoundError):
        read_current(spark, root)
    upsert_published(rows, root, ["k"])
    number, _ = current_version(spark, root)
    publish(spark.createDataFrame([("b", 2)], "k string, v int"), root, expected=number)
    with pytest.raises(StaleVersion):
        publish(rows, root, expected=number)
    assert [tuple(row) for row in read_current(spark, root).collect()] == [("b", 2)]
    (tmp_path / "report" / "commits" / "000000000003").touch()  # a writer that died before it named its version
    assert read_current(spark, root).count() == 1
    upsert_published(rows, root, ["k"])
    assert read_current(spark, root).count() == 2


def test_replace_keeps_the_columns_of_both_sides(spark, tmp_path):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, note string")
    source = spark.createDataFrame([("b", 9, 1.5), ("c", 3, 2.5)], "k string, v int, rate double")
    found = replace_into(target, source, ["k"])
    assert found.columns == ["k", "v", "note", "rate"]
    assert sorted(map(tuple, found.collect())) == [("a", 1, "old", None), ("b", 9, None, 1.5), ("c", 3, None, 2.5)]
    root = str(tmp_path / "report")
    publish(target, root)
    upsert_published(source, root, ["k"])
    assert {row.k: row.note for row in read_current(spark, root).collect()} == {"a": "old", "b": None, "c": None}


def test_readers_keep_the_columns_of_every_tenant(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("1", "w1")], "id string, warehouse_name string").write.parquet(f"{root}/erp_warehouse/tenant_db=erp_1")
    spark.createDataFrame([("2", "x")], "id string, extra string").write.parquet(f"{root}/erp_warehouse/tenant_db=erp_2")
    frame = read_tables(spark, root, ["erp_warehouse"])["erp_warehouse"]
    assert {(r.id, r.warehouse_name, r.extra, r.tenant_db) for r in frame.collect()} == {("1", "w1", None, "erp_1"), ("2", None, "x", "erp_2")}
    drift = {(r.missing_in, r.name) for r in column_drift(frame).collect()}
    assert drift == {("erp_1", "extra"), ("erp_2", "warehouse_name")}
    known = read_tables(spark, root, ["erp_warehouse"], schemas={"erp_warehouse": frame.schema})["erp_warehouse"]
    assert sorted(map(str, known.collect())) == sorted(map(str, frame.collect()))
    pruned = read_tables(spark, root, ["erp_warehouse"], tenants=["erp_2"])["erp_warehouse"]
    assert [r.id for r in pruned.collect()] == ["2"] and "extra" in pruned.columns


def test_scratch_goes_with_its_scope(spark, tmp_path):
    before = set(Path(shared_folder(spark).removeprefix("file:")).iterdir())
    with scratch_scope(spark):
        kept = store(spark.range(5), "scope")
        assert kept.count() == 5
    assert set(Path(shared_folder(spark).removeprefix("file:")).iterdir()) == before


def test_rewriting_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("a", 1, 1, 10), ("b", 1, 2, 20), ("c", 2, 1, 30), ("d", 2, None, 40)]
    spark.createDataFrame(rows, "k string, x int, y int, v int").write.partitionBy("x", "y").parquet(path)
    files = {file: file.stat().st_mtime_ns for file in (tmp_path / "table").rglob("*.parquet")}
    double = lambda df: df.withColumn("v", F.when(F.col("k").isin("b", "d"), F.col("v") * 2).otherwise(F.col("v")))
    assert rewrite_partitions(spark, path, lambda df: df.where(F.col("k").isin("b", "d")), double, ["x", "y"]) == 2
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("a", 10), ("b", 40), ("c", 30), ("d", 80)}
    same = {file for file in files if file.exists()}
    assert len(same) == 2 and all(file.stat().st_mtime_ns == files[file] for file in same)
    assert rewrite_partitions(spark, path, lambda df: df.where("k = 'zzz'"), double, ["x", "y"]) == 0


def test_partition_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = [("a", 1, 10), ("b", 1, 20), ("c", 2, 30)]
    spark.createDataFrame(rows, "k string, month int, v int").write.partitionBy("month").parquet(path)
    untouched = sorted(file.name for file in (tmp_path / "report" / "month=2").iterdir())
    source = spark.createDataFrame([("b", 1, 99), ("d", 3, 1)], "k string, month int, v int")
    upsert_partitions(source, path, ["k", "month"], ["month"])
    found = sorted((row.k, row.month, row.v) for row in spark.read.parquet(path).collect())
    assert found == [("a", 1, 10), ("b", 1, 99), ("c", 2, 30), ("d", 3, 1)]
    assert sorted(file.name for file in (tmp_path / "report" / "month=2").iterdir()) == untouched
    with pytest.raises(ValueError):
        upsert_partitions(source, path, ["k"], ["month"])


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


NESTED = "id int, s struct<a: int, t: struct<b: string>>, m map<string, int>, l array<int>, x string"


def test_differences_inside_nested_values(spark):
    left = spark.createDataFrame(
        [(1, (1, ("p",)), {"k": 1, "gone": None}, [1, 2], "same"), (2, None, {}, None, "x"), (3, (1, None), {}, [], "l")],
        NESTED,
    )
    right = spark.createDataFrame(
        [(1, (1, ("q",)), {"k": 2}, [1, 3, 4], "same"), (2, (5, None), {}, [], None), (4, None, None, None, "r")], NESTED
    )
    found = {(row.id, row.path, row.left, row.right) for row in snapshot_diff(left, right, ["id"]).collect()}
    assert found == {
        (1, "s.t.b", "p", "q"),
        (1, "m.k", "1", "2"),
        (1, "m.gone", None, None),
        (1, "l.1", "2", "3"),
        (1, "l.2", None, "4"),
        (2, "s", None, '{"a":5}'),
        (2, "l", None, "[]"),
        (2, "x", "x", None),
        (3, "s", '{"a":1}', None),
        (3, "m", "{}", None),
        (3, "l", "[]", None),
        (3, "x", "l", None),
        (4, "x", None, "r"),
    }
    assert snapshot_diff(left, left, ["id"]).count() == 0
    mirrored = {(row.id, row.path, row.right, row.left) for row in snapshot_diff(right, left, ["id"]).collect()}
    assert mirrored == found


def test_differences_cover_the_columns_of_both_sides(spark):
    left = spark.createDataFrame([(1, (1, 2), {"a.b": 1}, "1", "l")], "id int, s struct<a: int, b: int>, m map<string, int>, t string, old string")
    right = spark.createDataFrame([(1, (1, 3), {"a.b": 2}, 1, "r")], "id int, s struct<a: int, c: int>, m map<string, int>, t int, new string")
    found = {(r.path, r.left, r.right) for r in snapshot_diff(left, right, ["id"]).collect()}
    assert found == {
        ("s.b", "2", None),
        ("s.c", None, "3"),
        ("m.`a.b`", "1", "2"),
        ("t", "1", "1"),
        ("old", "l", None),
        ("new", None, "r"),
    }
    nested = spark.createDataFrame([(1, {"a": {"b": 1}, "x`y": {"z": 2}})], "id int, m map<string, map<string, int>>")
    dotted = spark.createDataFrame([(1, {"a.b": {"": 1}})], "id int, m map<string, map<string, int>>")
    paths = {r.path for r in snapshot_diff(nested, dotted, ["id"]).collect()}
    assert paths == {"m.a", "m.`a.b`", "m.`x``y`"}
    only_key = spark.createDataFrame([(1,), (2,)], "id int")
    assert snapshot_diff(only_key, only_key, ["id"]).count() == 0


def test_combinations_of_lists_with_gaps(spark):
    rows = [("p", "x", 0, "a"), ("p", "x", 2, "b"), ("p", "x", 2, "c"), ("p", "y", 7, "k"), ("q", "x", 5, "z")]
    options = spark.createDataFrame(rows, "product string, axis string, pos int, value string")
    found = [(r.product, r.ordinal, r.combination) for r in combinations(options, ["x", "y"]).orderBy("ordinal").collect()]
    assert found == [("p", 0, ["a", "k"]), ("p", 1, ["b", "k"]), ("p", 2, ["c", "k"])]
    counts = {r.product: r.combinations for r in combination_counts(options, ["x", "y"]).collect()}
    assert counts == {"p": 3, "q": 0}

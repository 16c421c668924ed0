"""Merkle manifest of a corpus: a content-addressed DAG, and the proof of every document by descent from its root.

Every row is a leaf, the SHA-256 of its fields. The leaves of a source, ascending by id, are joined in runs of ``FANOUT`` until one node,
the source's subroot, remains; the subroots, ordered by source, are joined in the same way to the root. The store holds one record per
distinct inner node: (digest, children), the children's digests one after the other.

A leaf's place is its path: one hex digit per level, those of its source's rank first, then those of its rank in the source. Requests
descend from the root. A step looks up the digests it has reached, takes the child that the next digit names and keeps the others as a
segment (left, right). Requests that begin with the same digits share these steps, so a step has one row per distinct beginning, and
the last one meets each run of leaves once. The segments, last first, are the leaf's proof.

NULL fields count as ``-``; a NULL source is a source of its own and comes first; rows without an id come first in their source. Rows
that tie (equal ids in one source) follow each other in the order of their digests; equal rows are leaves of their own with equal digests.
An empty table gives no rows. Other columns are ignored. Texts are hashed whole where they are read and never move.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.operators.numbering import number_rows
from ledgerlane.sources.publish import store

#: Children of a node. One hex digit of a rank names a child, so it is part of the format.
FANOUT = 16
#: Hex digits of a digest.
DIGEST = 64
#: Most bytes of sources that are broadcast; more take a shuffled join.
BROADCAST_BYTES = 16 << 20

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon and the value; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(fields[name]) for name in FIELDS]), 256)


@dataclass(frozen=True)
class Manifest:
    """``records`` (digest, children), ``leaves`` (doc_id, leaf, claim, path) and the root. ``top``: digits that name a source."""

    records: DataFrame
    leaves: DataFrame
    root: str | None
    top: int
    depth: int


def _levels(count: int) -> int:
    """Levels above ``count`` nodes until one is left."""
    return 0 if count <= 1 else len(f"{count - 1:x}")


def _digits(rank: Column, levels: Column) -> Column:
    """A rank in hex, one digit per level; the empty text for none."""
    return F.lpad(F.hex(rank), levels, F.lit("0"))


def _grow(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Joins runs of (tree, idx, n, digest) level by level; the records of each, and (tree, digest) of the node that remains of each tree.

    ``n`` is the number of nodes a tree has on this level and ``most`` the largest. A group holds at most ``FANOUT`` rows.
    """
    records, tops = [], nodes.where("n = 1").select("tree", "digest")
    for _ in range(_levels(most)):
        child = F.struct("idx", "digest")
        run = nodes.where("n > 1").groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"))
        run = run.agg(F.array_sort(F.collect_list(child)).alias("run"))
        run = run.select("tree", "idx", "n", F.array_join(F.col("run.digest"), "").alias("children"))
        nodes = store(run.withColumn("digest", F.sha2("children", 256)), "merkle-level")
        records.append(nodes.select("digest", "children"))
        tops = tops.unionByName(nodes.where("n = 1").select("tree", "digest"))
    return records, tops


def _bounded(sources: DataFrame) -> DataFrame:
    """The sources as a broadcast side if their measured size allows it."""
    size = sources.agg(F.count("*") * 64 + F.coalesce(F.sum(F.octet_length("_source")), F.lit(0))).first()[0]
    return F.broadcast(sources) if size <= BROADCAST_BYTES else sources


def build(docs: DataFrame, tampered: Column | None = None, changed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``claim`` is the digest a leaf claims to have: that of the fields as ``changed`` says where ``tampered``."""
    own = {name: F.col(name) for name in FIELDS}
    claim = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest({**own, **(changed or {})})) if tampered is not None else F.lit(None).cast("string")
    rows = docs.select(*FIELDS).withColumns({"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string")})
    rows = store(rows.select("doc_id", "source", leaf_digest(own).alias("leaf"), claim.alias("claim")), "merkle-leaves")
    numbered = number_rows(rows, [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("claim").asc()])
    sources = store(numbered.groupBy("source").agg(F.min("idx").alias("first"), F.count("*").alias("n")), "merkle-sources")
    sources = store(number_rows(sources, [F.col("first").asc()], "tree").withColumn("tree", F.col("tree") - 1), "merkle-sources")
    count, most = sources.agg(F.count("*"), F.max("n")).first()
    if not count:
        empty = rows.limit(0)
        return Manifest(empty.select(F.lit("").alias("digest"), F.lit("").alias("children")), empty.withColumn("path", F.lit("")), None, 0, 0)
    known = _bounded(sources.withColumnRenamed("source", "_source"))
    leaves = numbered.join(known, F.col("source").eqNullSafe(F.col("_source"))).withColumn("rank", F.col("idx") - F.col("first"))
    below, subroots = _grow(leaves.select("tree", F.col("rank").alias("idx"), "n", F.col("leaf").alias("digest")), most)
    subroots = store(subroots, "merkle-subroots")
    above, last = _grow(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("idx"), F.lit(count).alias("n"), "digest"), count)
    top, levels = _levels(count), F.when(F.col("n") > 1, F.length(F.hex(F.col("n") - 1))).otherwise(0)
    path = F.concat(_digits(F.col("tree"), F.lit(top)), _digits(F.col("rank"), levels))
    records = (below + above) or [subroots.limit(0).select("digest", F.lit("").alias("children"))]
    stored = records[0]
    for more in records[1:]:
        stored = stored.unionByName(more)
    stored = store(stored.distinct(), "merkle-records")
    return Manifest(stored, leaves.select("doc_id", "leaf", "claim", path.alias("path")), last.first().digest, top, top + _levels(most))


def _child(children: Column, place: Column) -> Column:
    return F.substr(children, place * DIGEST + 1, F.lit(DIGEST))


def _segment(children: Column, place: Column) -> Column:
    """The children beside the chosen one."""
    return F.struct(F.substr(children, F.lit(1), place * DIGEST).alias("left"), F.substr(children, (place + 1) * DIGEST + 1).alias("right"))


def _place(digit: Column) -> Column:
    return F.conv(digit, 16, 10).cast("int")


_SEGMENTS = "array<struct<left: string, right: string>>"


def _open_runs(manifest: Manifest, runs: DataFrame) -> DataFrame:
    """(prefix, children, subroot, segments) of all nodes on the way to the given runs (paths of nodes), from the root on."""
    opened = []
    for length in range(manifest.depth):
        if length:
            met = reached.join(manifest.records, "digest")
        else:
            subroot = F.lit(manifest.root if manifest.top == 0 else None).cast("string")
            met = manifest.records.where(F.col("digest") == manifest.root)
            met = met.withColumns({"prefix": F.lit(""), "subroot": subroot, "segments": F.array().cast(_SEGMENTS)})
        here = store(met.select("prefix", "children", "subroot", "segments"), "merkle-opened")
        opened.append(here)
        onward = runs.where(F.length("run") > length)
        onward = onward.select(F.expr(f"substring(run, 1, {length})").alias("prefix"), F.expr(f"substring(run, {length + 1}, 1)").alias("digit")).distinct()
        place, digest = _place(F.col("digit")), F.col("digest")
        reached = (
            onward.join(here, "prefix")
            .withColumn("digest", _child(F.col("children"), place))
            .select(
                F.concat("prefix", "digit").alias("prefix"),
                "digest",
                (digest if length + 1 == manifest.top else F.col("subroot")).alias("subroot"),
                F.concat("segments", F.array(_segment(F.col("children"), place))).alias("segments"),
            )
        )
    found = opened[0]
    for more in opened[1:]:
        found = found.unionByName(more)
    return found


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Per request (rows of ``manifest.leaves``; all by default): its digests, its proof and the root that claim and proof fold to."""
    leaves = manifest.leaves if requests is None else requests
    if manifest.root is None:
        kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, segments array<struct<left: string, right: string>>"
        return leaves.sparkSession.createDataFrame([], f"{kinds}, folded_root string, verified boolean")
    cut = leaves.withColumns(
        {
            "run": F.when(F.length("path") > 0, F.expr("left(path, length(path) - 1)")),
            "place": _place(F.expr("right(path, 1)")),
            "known": F.col("leaf"),
        }
    ).drop("path", "leaf")
    if manifest.depth:
        runs = store(cut.select("run").distinct(), "merkle-runs")
        met = cut.join(_open_runs(manifest, runs), F.col("run") == F.col("prefix"), "left")
    else:
        met = cut.withColumns({"children": F.lit(None).cast("string"), "subroot": F.lit(None).cast("string"), "segments": F.lit(None).cast(_SEGMENTS)})
    place, none = F.col("place"), F.array().cast(_SEGMENTS)
    leaf = F.coalesce(_child(F.col("children"), place), F.col("known"))
    own = F.when(F.col("children").isNotNull(), F.array(_segment(F.col("children"), place))).otherwise(none)
    upward = F.reverse(F.concat(F.coalesce("segments", none), own))
    proven = met.select("doc_id", leaf.alias("leaf"), "claim", "subroot", upward.alias("segments"))
    siblings = F.array_join(F.transform("segments", lambda part: F.concat(part["left"], part["right"])), "")
    folded = F.aggregate("segments", F.coalesce("claim", "leaf"), lambda node, part: F.sha2(F.concat(part["left"], node, part["right"]), 256))
    root = F.lit(manifest.root)
    return proven.select(
        "doc_id",
        "leaf",
        F.coalesce("subroot", "leaf").alias("subroot"),
        root.alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        "segments",
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

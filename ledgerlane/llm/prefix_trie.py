"""Prefix trie of conversations, with a count-min sketch that keeps unshared tails out of the shuffle.

The digest of a prefix is the exclusive or of 128-bit hashes of its (position, role, text), so digests of a sorted table are running sums:
a task sums its rows, and what the earlier tasks hold of the conversation it begins with is added afterwards. No step gathers a conversation,
so one with a third of all turns is spread like the others.

The digests of all prefixes go into a count-min sketch of a fixed size. An estimate of one is exact: the prefix belongs to one conversation
alone, and so does all that follows. Such nodes are written where they are read. Only prefixes that may be shared are grouped by digest;
false alarms of the sketch are nodes with one member there, so the result doesn't depend on the sketch's width.

A node's representative is its smallest member. Sums over a subtree are taken along conversations: what a node adds stands at its
representative, a running sum from the last turn back gives each member what stands below, and the members' sums add up to the node's.
The ids that end at a node are hashed in a stream over sorted pieces of ``PIECE`` ids.

NULL role or text counts as empty. Turns of one conversation with equal numbers follow each other in the order of their digests; repeated
rows are turns of their own. Rows without a conversation id belong to none and are left out. An empty table gives no rows. Other columns are
ignored. Texts are hashed where they are read and never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import mixed, ship, word_count
from ledgerlane.llm.counting import Tally, starts
from ledgerlane.sources.publish import store

#: Cells of a row of the sketch, at most; two rows of one bit each are 16 MB. It is made four times as wide as there are prefixes.
WIDEST = 1 << 26
ROWS = 2
#: Ids of one piece of a list.
PIECE = 4096


def _lane(digest: Column, lane: int) -> Column:
    """64 bits of a hex digest."""
    return F.conv(F.substring(digest, 1 + 16 * lane, 16), 16, -10).cast("long")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, a, b, words): the turns with a digest in place of role and text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), digest.alias("d"), word_count(text).alias("words"))
    return rows.select("conv_id", "turn", _lane(F.col("d"), 0).alias("a"), _lane(F.col("d"), 1).alias("b"), "words")


_SUM = {"add": (np.add, np.subtract), "xor": (np.bitwise_xor, np.bitwise_xor)}


def running(rows: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` with running sums (``add`` or ``xor``) in ``order``, which starts with ``conv_id``, instead of the named long columns.

    Every task sums the rows it sorts. What a conversation has in earlier tasks is added from one row per task.
    """
    ship(rows.sparkSession)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slot, step, last, state = TaskContext.get().partitionId(), 0, None, dict.fromkeys(sums, 0)
        for batch in batches:
            if not (count := batch.num_rows):
                continue
            keys = batch.column("conv_id").to_numpy()
            first = starts(keys)
            segment = np.repeat(np.arange(len(first)), np.diff(first, append=count))
            columns = {name: batch.column(name) for name in names}
            for name, kind in sums.items():
                together, without = _SUM[kind]
                total = together.accumulate(columns[name].to_numpy().astype(np.int64))
                found = without(total, np.where(first > 0, total[first - 1], 0)[segment])
                if keys[0] == last:
                    found[: first[1] if len(first) > 1 else count] = together(found[: first[1] if len(first) > 1 else count], state[name])
                state[name] = found[-1]
                columns[name] = pa.array(found)
            last = keys[-1]
            columns |= {"slot": pa.array(np.full(count, slot, np.int32)), "step": pa.array(np.arange(step, step + count))}
            step += count
            yield pa.RecordBatch.from_pydict(columns)

    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{kinds}, slot int, step long")
    placed = store(placed, "running")
    ends = placed.groupBy("slot").agg(
        F.min_by("conv_id", "step").alias("first"),
        F.max_by("conv_id", "step").alias("last"),
        *(F.max_by(name, "step").alias(name) for name in sums),
    )
    carried, before = [], None
    for row in ends.orderBy("slot").collect():  # one row per task
        over = dict.fromkeys(sums, 0)
        if before and before[0] == row.first:
            over = before[1]
            carried.append((row.slot, row.first, *over.values()))
        whole = row.first == row.last
        together = {name: int(_SUM[kind][0](np.int64(row[name]), np.int64(over[name] if whole else 0))) for name, kind in sums.items()}
        before = (row.last, together)
    if not carried:
        return placed.drop("slot", "step")
    schema = "slot int, conv_id long, " + ", ".join(f"_{name} long" for name in sums)
    more = F.broadcast(rows.sparkSession.createDataFrame(carried, schema))
    joined = placed.join(more, ["slot", "conv_id"], "left")
    for name, kind in sums.items():
        extra = F.coalesce(f"_{name}", F.lit(0).cast("long"))
        joined = joined.withColumn(name, F.col(name) + extra if kind == "add" else F.col(name).bitwiseXOR(extra))
    return joined.select(names)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, words): the turns numbered from 1 in each conversation."""
    rows = store(turn_rows(conversations).withColumn("pos", F.lit(1).cast("long")), "turns")
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("a").asc(), F.col("b").asc()]
    return running(rows, order, {"pos": "add"}).drop("turn")


def rebuilt(turns: DataFrame, donor: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``heads`` (at most ``most``) turns of their ``donor`` and go on with their own behind as many.

    Returns the turns (conv_id, pos, a, b, words, length) and (conv_id, length) of every conversation, those without turns too.
    """
    convs = store(turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumns({"donor": donor, "heads": heads}), "conversations")
    donors = convs.select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n"))
    given = F.least(F.col("heads"), F.coalesce("donor_n", F.lit(0)))
    plans = convs.join(donors, "donor", "left").withColumn("given", given)
    plans = plans.withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("heads"), F.lit(0)))
    plans = store(plans.select("conv_id", "donor", "heads", "given", "length"), "plans")
    first = turns.where(F.col("pos") <= most).join(plans.select("donor").distinct(), F.col("conv_id") == F.col("donor"), "left_semi")
    first = first.withColumnRenamed("conv_id", "donor")
    begins = plans.where("given > 0").join(first, "donor").where("pos <= given").select("conv_id", "pos", "a", "b", "words", "length")
    goes_on = turns.join(plans, "conv_id").where("pos > heads")
    goes_on = goes_on.select("conv_id", (F.col("pos") - F.col("heads") + F.col("given")).alias("pos"), "a", "b", "words", "length")
    return begins.unionByName(goes_on), plans.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, x, y, px, py, words, length): every prefix with its digest and that of the prefix one turn shorter."""
    own = [F.xxhash64(F.lit(lane), "pos", "a", "b") for lane in (1, 2)]
    rows = turns.select("conv_id", "pos", own[0].alias("x"), own[1].alias("y"), own[0].alias("px"), own[1].alias("py"), "words", "length")
    found = running(store(rows, "rebuilt"), [F.col("conv_id").asc(), F.col("pos").asc()], {"x": "xor", "y": "xor"})
    return found.withColumns({"px": F.col("px").bitwiseXOR(F.col("x")), "py": F.col("py").bitwiseXOR(F.col("y"))})


def _cells(x: np.ndarray, y: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each digest in each row of the sketch."""
    x, y = x.astype(np.uint64), y.astype(np.uint64)
    return [(mixed(x + y * np.uint64(2 * row + 1)) & np.uint64(width - 1)) + np.uint64(row * width) for row in range(ROWS)]


def sketch(digests: DataFrame, width: int) -> np.ndarray:
    """Count-min sketch of digests (x, y), reduced to a bit per cell: whether its count is above one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Tally()

        def send() -> pa.RecordBatch:
            cells, counts = met.take()
            return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(counts.astype(np.int64))], ["cell", "n"])

        for batch in batches:
            if met.add(np.concatenate(_cells(batch.column("x").to_numpy(), batch.column("y").to_numpy(), width))):
                yield send()
        yield send()

    counted = digests.select("x", "y").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    bit = F.expr("shiftleft(1L, cast(cell % 64 AS int))")
    words = counted.where("n > 1").groupBy(F.expr("cell div 64").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    above = np.zeros(max(ROWS * width // 64, 1), np.uint64)
    above[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint64)
    return above


def screened(paths: DataFrame, widest: int = WIDEST) -> DataFrame:
    """``paths`` with ``single`` and ``parent_single``: whether the sketch proves that no other conversation has the prefix."""
    width = min(widest, 1 << max(6, (4 * paths.count()).bit_length()))
    above = paths.sparkSession.sparkContext.broadcast(sketch(paths, width))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = above.value

        def alone(x: pa.Array, y: pa.Array) -> np.ndarray:
            shared = np.ones(len(x), bool)
            for cell in _cells(x.to_numpy(), y.to_numpy(), width):
                shared &= (bits[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) > 0
            return ~shared

        for batch in batches:
            own, parent = (alone(batch.column(x), batch.column(y)) for x, y in (("x", "y"), ("px", "py")))
            parent &= batch.column("pos").to_numpy() > 1  # the root is everybody's
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(parent)], [*batch.schema.names, "single", "parent_single"])

    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in paths.schema)
    return paths.mapInArrow(screen, f"{kinds}, single boolean, parent_single boolean")


def _digests_of_ends(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256) of the ids (x, y, conv_id), ascending and joined by commas.

    Tasks join sorted ids to pieces; a node's pieces then pass, in order, through one hash, of which only its state is held.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, ids = (batch.column(name).to_numpy() for name in ("x", "y", "conv_id"))
            at = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(x) else []
            rows = [(a, min(b, a + PIECE)) for s, e in zip(at, [*at[1:], len(x)]) for a, b in ((k, e) for k in range(s, e, PIECE))]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in rows]
            first = [a for a, _ in rows]
            yield pa.RecordBatch.from_pydict({"x": x[first], "y": y[first], "first": ids[first], "ids": pa.array(texts, pa.string())}) if rows else pa.RecordBatch.from_pydict(
                {"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "ids": pa.array([], pa.string())}
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"x": pa.array([node[0]], pa.int64()), "y": pa.array([node[1]], pa.int64()), "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            for x, y, ids in zip(*(batch.column(name).to_pylist() for name in ("x", "y", "ids"))):
                if (x, y) == node:
                    state.update(b",")
                else:
                    if node:
                        yield done()
                    node, state = (x, y), hashlib.sha256()
                state.update(ids.encode())
        if node:
            yield done()

    order = ["x", "y", "conv_id"]
    cut = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "x long, y long, first long, ids string")
    return cut.repartition("x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(hashed, "x long, y long, ends_sha256 string")


_NOTHING = hashlib.sha256(b"").hexdigest()


def trie(turns: DataFrame, convs: DataFrame, widest: int = WIDEST) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos, a, b, words, length); ``convs`` (conv_id, length) also names those without turns.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    """
    paths = store(screened(prefixes(turns), widest), "paths")
    zero = F.lit(0).cast("long")
    local = paths.where("single")
    roots = convs.select("conv_id", zero.alias("pos"), *(zero.alias(name) for name in ("x", "y", "px", "py", "words")), "length")
    shared = paths.where("NOT single").select(*roots.columns).unionByName(roots)
    nodes = shared.groupBy("x", "y", "pos").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.max(name).alias(name) for name in ("words", "px", "py"))
    )
    nodes = store(nodes, "nodes")
    onward = local.where("NOT parent_single").select("conv_id", "pos", "x", "y", "px", "py", "length")
    kids = nodes.where("pos > 0").select("px", "py").unionByName(onward.select("px", "py")).groupBy("px", "py").agg(F.count("*").alias("n_children"))
    counted = nodes.join(kids.withColumnsRenamed({"px": "x", "py": "y"}), ["x", "y"], "left")
    counted = store(counted.withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    gain = (F.col("n_convs") - 1) * F.col("words")
    told = counted.select("conv_id", "pos", zero.alias("member"), "x", "y", gain.alias("saved_tokens"), (F.col("n_children") == 0).cast("long").alias("n_leaves"))
    tails = local.where("pos = length").select("conv_id", "pos", zero.alias("member"), "x", "y", zero.alias("saved_tokens"), F.lit(1).cast("long").alias("n_leaves"))
    asked = shared.select("conv_id", "pos", F.lit(1).cast("long").alias("member"), "x", "y", zero.alias("saved_tokens"), zero.alias("n_leaves"))
    marks = store(told.unionByName(tails).unionByName(asked), "marks")
    below = running(marks, [F.col("conv_id").asc(), F.col("pos").desc(), F.col("member").asc()], {"saved_tokens": "add", "n_leaves": "add"})
    sums = below.where("member = 1").groupBy("x", "y").agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    ends = _digests_of_ends(shared.where("pos = length"))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    full = counted.join(sums, ["x", "y"]).join(ends, ["x", "y"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING)))
    full = full.select("conv_id", F.col("pos").alias("depth"), "px", "py", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    last = F.col("pos") == F.col("length")
    one = F.lit(1).cast("long")
    alone = local.select(
        "conv_id",
        F.col("pos").alias("depth"),
        "px",
        "py",
        one.alias("n_convs"),
        F.when(last, zero).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_NOTHING)).alias("ends_sha256"),
        "parent_single",
    )
    # A parent that is not among the shared nodes has this conversation alone.
    parents = counted.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent"))
    asking = full.where("depth > 0").unionByName(alone.where("NOT parent_single").drop("parent_single"))
    found = asking.join(parents, ["px", "py"], "left").withColumn("parent_conv_id", F.coalesce("parent", "conv_id"))
    inner = alone.where("parent_single").withColumn("parent_conv_id", F.col("conv_id"))
    root = full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return found.select(columns).unionByName(inner.select(columns)).unionByName(root.select(columns))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = ordered_turns(conversations)
    lengths = store(turns.groupBy("conv_id").agg(F.count("*").alias("length")), "lengths")
    return trie(turns.join(lengths, "conv_id"), lengths)

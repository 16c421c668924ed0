"""Combinations of option lists, for many products at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = 1 << 16  # tuple numbers generated per row before they are spread over the tasks


def combination_counts(options: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Number of options per axis and of combinations per product, known before anything is expanded."""
    if not axes:
        return options.select("product").distinct().withColumn("combinations", F.lit(1).cast("long"))
    sizes = options.groupBy("product").agg(
        *[F.count(F.when(F.col("axis") == axis, 1)).alias(f"size_{k}") for k, axis in enumerate(axes)]
    )
    total = reduce(lambda left, right: left * right, [F.col(f"size_{k}") for k in range(len(axes))], F.lit(1))
    return sizes.withColumn("combinations", total.cast("long"))


def combinations(options: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Every choice of one option per axis, as ``product, ordinal, combination``, the last axis varying fastest.

    ``options`` has ``product, axis, pos, value``; ``pos`` orders the axis' list and may have gaps. A product that lacks
    an axis has no combinations; without axes every product has the empty one. Tuples are numbered and each number is
    read as mixed-radix digits, one digit per axis, which look their option up by equality. So nothing is crossed,
    no option list is gathered in one place, and the numbers of one large product are made on many tasks.
    """
    counts = combination_counts(options, axes).where(F.col("combinations") > 0)
    chunks = counts.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(combinations - 1) div {_CHUNK}")))
    ).repartition("product", "chunk")
    first = F.col("chunk") * _CHUNK
    last = F.least(first + _CHUNK, F.col("combinations")) - 1
    tuples = chunks.withColumn("ordinal", F.explode(F.sequence(first, last)))

    # The place in the list, whatever the positions are; equal positions follow in value order.
    listed = Window.partitionBy("product", "axis").orderBy("pos", "value")
    placed = options.where(F.col("axis").isin(list(axes))).withColumn("_digit", (F.row_number().over(listed) - 1).cast("long"))
    for k, axis in enumerate(axes):
        stride = " * ".join(["1L", *(f"size_{j}" for j in range(k + 1, len(axes)))])
        digit = F.expr(f"(ordinal div ({stride})) % size_{k}")
        choices = placed.where(F.col("axis") == axis).select("product", "_digit", F.col("value").alias(f"value_{k}"))
        tuples = tuples.withColumn("_digit", digit).join(choices, ["product", "_digit"]).drop("_digit")
    return tuples.select(
        "product", "ordinal", F.array(*[F.col(f"value_{k}") for k in range(len(axes))]).cast("array<string>").alias("combination")
    )


def ragged_counts(axes: DataFrame, options: DataFrame) -> DataFrame:
    """(product, axes, combinations): how many option lists each product has, and how many choices of one option from each.

    ``axes`` has ``product, axis_no, axis``, one row per list, and a row with a NULL axis for a product without any; ``options`` has
    ``product, axis, pos, value``. A product without lists has one combination, the empty one; one with an empty list has none.
    """
    return _ragged_plans(axes, options).select("product", F.size("sizes").cast("long").alias("axes"), "combinations")


def _ragged_plans(axes: DataFrame, options: DataFrame) -> DataFrame:
    """Per product the sizes of its lists in the order of the axes, which bounds the array, and their product."""
    sizes = options.groupBy("product", "axis").agg(F.count("*").alias("size"))
    listed = axes.join(sizes, ["product", "axis"], "left").withColumn("size", F.coalesce("size", F.lit(0)))
    entry = F.when(F.col("axis").isNotNull(), F.struct("axis_no", "axis", "size"))
    plans = listed.groupBy("product").agg(F.array_sort(F.collect_list(entry)).alias("sizes"))
    total = F.aggregate("sizes", F.lit(1).cast("long"), lambda product, axis: product * axis["size"])
    return plans.withColumn("combinations", total)


def ragged_combinations(axes: DataFrame, options: DataFrame) -> DataFrame:
    """Every choice of one option per list, for products with any number of lists: ``product, ordinal, combination``.

    Input as in :func:`ragged_counts`; the last list varies fastest. Choices are numbered from 0 and a number's mixed-radix digits, one per list
    of its product, become rows that look their option up in one join; a choice is put together again from its digits, as many as its
    product has lists. No product's choices are gathered in one place, and a product with most of the choices is made on many tasks.
    """
    plans = _ragged_plans(axes, options).where("combinations > 0")
    chunks = plans.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(combinations - 1) div {_CHUNK}")))
    ).repartition("product", "chunk")
    first = F.col("chunk") * _CHUNK
    ordinals = F.sequence(first, F.least(first + _CHUNK, F.col("combinations")) - 1)
    numbered = chunks.select("product", "sizes", F.explode(ordinals).alias("ordinal"))

    # From the last list to the first: the digit is the remainder, and the rest goes on.
    state = F.struct(F.col("ordinal").alias("rest"), F.array().cast("array<struct<axis_no: bigint, axis: string, digit: bigint>>").alias("digits"))

    def digit(done, axis):
        here = F.struct(axis["axis_no"].cast("long").alias("axis_no"), axis["axis"].alias("axis"), (done["rest"] % axis["size"]).alias("digit"))
        return F.struct(F.call_function("div", done["rest"], axis["size"]).alias("rest"), F.array_append(done["digits"], here).alias("digits"))

    digits = F.aggregate(F.reverse("sizes"), state, digit)["digits"]
    each = numbered.select("product", "ordinal", F.explode_outer(digits).alias("digit")).select("product", "ordinal", "digit.*")
    listed = Window.partitionBy("product", "axis").orderBy("pos", "value")
    placed = options.withColumn("digit", (F.row_number().over(listed) - 1).cast("long")).select("product", "axis", "digit", "value")
    chosen = each.join(placed, ["product", "axis", "digit"], "left")
    part = F.when(F.col("axis").isNotNull(), F.struct("axis_no", "value"))
    whole = chosen.groupBy("product", "ordinal").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.select("product", "ordinal", F.col("parts.value").cast("array<string>").alias("combination"))

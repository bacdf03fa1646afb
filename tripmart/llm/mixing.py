"""Mixing sources to target weights by entropy balancing.

Rates stay as near to their base (relative entropy, weighted by size) as the token targets allow, so they are base
rates tilted exponentially, min(most, base * exp(lambda of the source)). Each lambda solves its source's share of the
convex dual; Newton's steps for all sources come from one distributed aggregation per iteration. Documents of equal
size, base and source are one row of it.

Rates are rounded into whole copies. Every document gets floor(rate) copies; what is missing to the target is given to
sizes from the largest down, each taking as many further copies as the tokens owed so far pay for, so the error left
is about the smallest document. Documents of a whole rate get no further copy. Which documents of a size get one is decided by a hash, ranked within hash buckets:
many equal documents are never sorted together.

Defined results: null source is a source of its own and comes last. Null text has size 0 and takes nothing. Sources
without words have target 0. Repeated rows are mixed as documents of their own; which of them gets a further copy
does not show. No rows: no rows. Reruns agree, as nothing depends on partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import shared, text_key

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
BUCKETS = 256
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ordinals(frame: DataFrame, *order: Column) -> DataFrame:
    """Numbers rows from 0 in the given order, each range of them in a task of its own."""
    ranged = shared(frame.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()))
    counts = ranged.groupBy("range_").agg(F.count(F.lit(1)).alias("rows_"))
    before = F.coalesce(
        F.sum("rows_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    within = F.row_number().over(Window.partitionBy("range_").orderBy(*order))
    return (
        ranged.withColumn("within_", within).join(counts.select("range_", before.alias("before_")), "range_")
        .withColumn("ordinal", F.col("before_") + F.col("within_") - 1).drop("range_", "before_", "within_")
    )


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """sizes: (source, source_size). Adds weight and target; targets above `most` sizes are cut and the excess is
    shared by weight among the others until none is above."""
    ranked = ordinals(sizes, F.col("source").asc_nulls_last())
    repeating = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                             (F.col("ordinal") % len(weights) + 1).cast("int"))
    weighed = shared(ranked.select("source", "source_size", repeating.alias("weight")))
    limit = F.col("source_size") * most
    total, shares = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    level = total / shares if shares else 0.0
    while shares:
        above = limit < F.col("weight") * level
        cut, rest = weighed.agg(F.sum(F.when(above, limit).otherwise(0.0)),
                                F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if not rest or (found := (total - cut) / rest) <= level * (1 + 1e-15):
            break
        level = found
    return weighed.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def balanced_rates(classes: DataFrame, targets: DataFrame, most: float = MOST, tolerance: float = 1e-12) -> DataFrame:
    """classes: (source, base, tokens). Gives the rate of each class. The tokens a source takes grow with its tilt, so
    every tilt tried bounds the root from one side. Newton's steps on their logarithm find it; where a step leaves the
    bounds, or the last one has not halved the error, the bounds are halved instead, and as long as one side has no
    bound, its distance doubles. So the rounds are bounded by the digits of the tilt, whatever the bases."""
    none = F.lit(None).cast("double")
    state = shared(targets.select(F.col("source").alias("of"), "target", F.lit(0.0).alias("tilt"), none.alias("low"),
                                  none.alias("high"), none.alias("off"), F.lit(False).alias("full")))
    same = F.col("source").eqNullSafe(F.col("of"))
    tilted = F.col("base") * F.exp("tilt")
    while True:
        held = F.col("tokens") * F.least(tilted, F.lit(most))
        sums = (
            classes.join(state, same).groupBy("of", "target", "tilt", "low", "high", F.col("off").alias("last"))
            .agg(F.sum(held).alias("held"), F.sum(F.when(tilted < most, held).otherwise(0.0)).alias("moves"),
                 F.sum(F.col("tokens") * most).alias("limit"))
        )
        full = F.col("target") >= F.col("limit") * (1 - tolerance)
        few = F.col("held") < F.col("target")
        sums = sums.withColumns({
            "full": full, "low": F.when(few, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(few, F.col("high")).otherwise(F.col("tilt")),
            "off": F.when((F.col("held") > 0) & (F.col("target") > 0) & ~full, F.abs(F.col("held") / F.col("target") - 1)).otherwise(0.0),
            # Where all rates are at the limit, no step is known.
            "newton": F.when(F.col("moves") > 0, F.col("tilt") + F.log(F.col("target") / F.col("held")) * F.col("held") / F.col("moves")),
        })
        far = F.greatest(F.lit(1.0), F.abs("tilt"))
        inside = ((F.col("low").isNull() | (F.col("newton") > F.col("low")))
                  & (F.col("high").isNull() | (F.col("newton") < F.col("high"))))
        slow = F.col("low").isNotNull() & F.col("high").isNotNull() & (F.col("off") > F.col("last") / 2)
        following = (F.when(F.col("newton").isNotNull() & inside & ~F.coalesce(slow, F.lit(False)), F.col("newton"))
                     .otherwise(F.coalesce((F.col("low") + F.col("high")) / 2, F.col("tilt") + F.when(few, far).otherwise(-far))))
        narrow = F.coalesce(F.col("high") - F.col("low") <= 1e-15 * far, F.lit(False))
        stepped = shared(sums.select(
            "of", "target", "low", "high", "full", F.when(narrow, 0.0).otherwise(F.col("off")).alias("off"),
            F.when((F.col("off") > 1e-9) & ~narrow, following).otherwise(F.col("tilt")).alias("tilt")))
        state, off = stepped, stepped.agg(F.max("off")).first()[0]
        if off is None or off <= 1e-9:
            break
    rate = F.when(F.col("full"), F.lit(most)).otherwise(F.least(tilted, F.lit(most)))
    return classes.join(state, same).select("source", "base", rate.alias("rate"))


def further_copies(rows: pd.DataFrame) -> pd.DataFrame:
    """For one source: how many documents of each size get a copy more, from the largest size down."""
    rows = rows.sort_values(["size", "rate"], ascending=False).reset_index(drop=True)
    owed, given = 0.0, []
    for size, n, rate in zip(rows["size"], rows["n"], rows["rate"], strict=True):
        owed += (rate - math.floor(rate)) * size * n
        count = min(int(n), int(owed // size)) if size and rate > math.floor(rate) else 0
        owed -= count * size
        given.append(count)
    rows["given"] = given
    spare = rows[(rows["given"] < rows["n"]) & (rows["size"] > 0) & (rows["rate"] > rows["rate"].map(math.floor))]
    if len(spare):
        nearest = (spare["size"] - owed).abs().idxmin()
        if abs(rows.loc[nearest, "size"] - owed) < owed:
            rows.loc[nearest, "given"] += 1
    return rows[["source", "size", "rate", "given"]]


def mix(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    base: Column | None = None, weights: Sequence[float] = WEIGHTS, most: float = MOST,
) -> DataFrame:
    """One row per document: row (its id), key (of its text), source, size, source_size, target, rate, copies, taken.
    base: a positive base rate per document, 1 if none is given."""
    measured = shared(docs.select(
        F.col(id_column).alias("row"), text_key(F.col(text_column)).alias("key"), F.col(source_column).alias("source"),
        word_count(F.col(text_column)).alias("size"), (F.lit(1.0) if base is None else base.cast("double")).alias("base"),
    ))
    sizes = shared(measured.groupBy("source", "size", "base").agg(F.count(F.lit(1)).alias("n")))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = shared(source_targets(totals, weights, most))
    tokens = shared(sizes.groupBy("source", "base").agg(F.sum(F.col("size") * F.col("n")).cast("double").alias("tokens")))
    rates = shared(balanced_rates(tokens, targets, most))
    at = ["source", "size", "rate"]
    named = rates.select(F.col("source").alias("of"), F.col("base").alias("of_base"), "rate")
    has_rate = F.col("source").eqNullSafe(F.col("of")) & (F.col("base") == F.col("of_base"))
    rated = sizes.join(named, has_rate).groupBy(*at).agg(F.sum("n").alias("n"))
    source_type = docs.schema[source_column].dataType.simpleString()
    given = rated.groupBy("source").applyInPandas(
        further_copies, f"source {source_type}, size bigint, rate double, given bigint")

    place = F.xxhash64(F.col("row").cast("string"), "key")
    rows = measured.join(named, has_rate).select(
        "row", "key", "source", "size", "rate", place.alias("place"), F.pmod(place, F.lit(BUCKETS)).alias("bucket"))
    by_class = Window.partitionBy(*at).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        rows.groupBy(*at, "bucket").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(by_class), F.lit(0)))
    )
    quotas = quotas.alias("q").join(
        given.alias("g"), F.col("q.source").eqNullSafe(F.col("g.source")) & (F.col("q.size") == F.col("g.size"))
        & (F.col("q.rate") == F.col("g.rate"))
    ).select("q.source", "q.size", "q.rate", "q.bucket", (F.col("given") - F.col("before")).alias("left"))
    ranked = rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*at, "bucket").orderBy("place", "key", "row")))
    more = (F.col("rank") <= F.col("left")).cast("bigint")
    copies = F.floor("r.rate").cast("bigint") + more
    chosen = ranked.alias("r").join(
        quotas.alias("q"), F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r.size") == F.col("q.size"))
        & (F.col("r.rate") == F.col("q.rate")) & (F.col("r.bucket") == F.col("q.bucket"))
    ).select("r.row", "r.key", "r.source", "r.size", "r.rate", copies.alias("copies"))
    return chosen.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        "c.row", "c.key", "c.source", "c.size", F.col("t.source_size").cast("bigint").alias("source_size"),
        F.col("t.target").alias("target"), "c.rate", "c.copies", (F.col("c.copies") * F.col("c.size")).alias("taken"),
    )

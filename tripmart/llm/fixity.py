"""WARC fixity audit with Merkle trees over two replicas.

Leaves are the records of one id: how many, how many bytes, and the SHA-256 of each record's length and content
(records of one id are combined by sums, so their order does not matter and no group of them is collected). A node
covers an ordered range of ids and so of offsets, and hashes its children in order, at most 64 of them. Both trees
have ranges of the same ids, so a missing record does not shift what follows. The audit compares the roots and then,
level by level, only children of nodes that differ, down to the damaged records: either side of a level is reduced to
them before the sides are joined, and the audit ends at the first level without any. The bytes of all siblings before
them add up to their offset in each replica.

Defined results: null content is an empty record, unlike a missing one (the length says so). Records with null id make
a leaf after all others. Empty replicas: every record of the other is missing or extra. Equal roots: no rows.
Content of any length is hashed whole. Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import shared

FAN_BITS = 6
SUMMED = ("n_records", "n_bytes", "part0", "part1", "part2", "part3")


def leaves(records: DataFrame, id_column: str, content: list[str]) -> DataFrame:
    """(node, is_null, n_records, n_bytes, hash) for every id."""
    size = lambda name: F.octet_length(F.col(name).cast("binary"))
    frame = [F.concat(F.coalesce(size(name).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(name), F.lit("")))
             for name in content]
    digest = F.sha2(F.concat(*frame), 256)
    part = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")
    total = sum((F.coalesce(size(name), F.lit(0)).cast("bigint") for name in content), F.lit(0).cast("bigint"))
    return (
        records.select(F.col(id_column).cast("bigint").alias("node"), total.alias("bytes"),
                       *[part(1 + 15 * k).alias(f"part{k}") for k in range(4)])
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("n_records"), F.sum("bytes").alias("n_bytes"),
             *[F.sum(f"part{k}").alias(f"part{k}") for k in range(4)])
        .select(
            F.coalesce("node", F.lit(0)).alias("node"), F.col("node").isNull().alias("is_null"),
            "n_records", "n_bytes",
            F.sha2(F.concat_ws(",", *[F.col(name).cast("string") for name in SUMMED]), 256).alias("hash"),
        )
    )


def parents(nodes: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("node", "hash")))
    child = lambda one: F.concat_ws(":", one["node"].cast("string"), one["hash"])
    return (
        nodes.groupBy(F.shiftright("node", FAN_BITS).alias("node"), "is_null")
        .agg(F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes"), ordered.alias("children"))
        .select("node", "is_null", "n_records", "n_bytes",
                F.sha2(F.concat_ws(",", F.transform("children", child)), 256).alias("hash"))
    )


def tree(records: DataFrame, id_column: str, content: list[str], levels: int) -> list[DataFrame]:
    """The levels of the tree from the leaves up, each written once; few rows above the leaves."""
    grown = [shared(leaves(records, id_column, content))]
    for _ in range(levels):
        grown.append(shared(parents(grown[-1])))
    return grown


def tree_height(*replicas: tuple[DataFrame, str]) -> int:
    """Levels above the leaves until negative and other ids have one node each."""
    widest = 0
    for records, id_column in replicas:
        ends = records.agg(F.min(id_column).cast("bigint").alias("low"), F.max(id_column).cast("bigint").alias("high"))
        low, high = ends.first()
        widest = max(widest, *(value.bit_length() for value in (low or 0, high or 0)))
    return -(-widest // FAN_BITS) + 1


def audit(
    primary: DataFrame, replica: DataFrame, *, id_column: str = "page_id", content: tuple[str, ...] = ("url", "html")
) -> DataFrame:
    """One row per damaged id: id, status (changed, missing or extra in the replica), and for either replica the
    number of records, bytes and offset (bytes of all records before it in id order)."""
    height = tree_height((primary, id_column), (replica, id_column))
    trees = [tree(records, id_column, list(content), height) for records in (primary, replica)]
    suspects = None
    for depth in range(height, -1, -1):
        sides = []
        for side, levels in zip(("left", "right"), trees, strict=True):
            nodes = levels[depth].select(
                "node", "is_null", F.col("n_records").alias(f"{side}_records"), F.col("n_bytes").alias(f"{side}_bytes"),
                F.col("hash").alias(f"{side}_hash"))
            if suspects is not None:  # children of nodes that differ, before anything is joined
                below = nodes.withColumn("up", F.shiftright("node", FAN_BITS))
                nodes = below.join(suspects.select("up", "is_null"), ["up", "is_null"], "left_semi").drop("up")
            sides.append(nodes)
        children = sides[0].join(sides[1], ["node", "is_null"], "full")
        if suspects is None:
            children = children.withColumns({"up": F.lit(0), "left_before": F.lit(0).cast("bigint"),
                                             "right_before": F.lit(0).cast("bigint")})
            siblings = Window.orderBy("is_null", "node")
        else:
            children = children.withColumn("up", F.shiftright("node", FAN_BITS)).join(suspects, ["up", "is_null"])
            siblings = Window.partitionBy("up", "is_null").orderBy("node")
        earlier = siblings.rowsBetween(Window.unboundedPreceding, -1)
        placed = children.withColumns({
            f"{side}_at": F.col(f"{side}_before") + F.coalesce(F.sum(f"{side}_bytes").over(earlier), F.lit(0))
            for side in ("left", "right")
        })
        differ = placed.where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))
        found = differ.select("node", "is_null", "left_records", "left_bytes", "left_at", "left_hash",
                              "right_records", "right_bytes", "right_at", "right_hash")
        if depth:
            suspects = shared(found.select(F.col("node").alias("up"), "is_null",
                                           F.col("left_at").alias("left_before"), F.col("right_at").alias("right_before")))
            if suspects.isEmpty():
                break
    here = lambda side, name: F.when(F.col(f"{side}_hash").isNotNull(), F.col(f"{side}_{name}"))
    return found.select(
        F.when(~F.col("is_null"), F.col("node")).alias("id"), status().alias("status"),
        *[here(side, name).alias(f"{title}_{label}")
          for side, title in (("left", "primary"), ("right", "replica"))
          for name, label in (("records", "records"), ("bytes", "bytes"), ("at", "offset"))],
    )


def status() -> Column:
    return (F.when(F.col("right_hash").isNull(), "missing").when(F.col("left_hash").isNull(), "extra")
            .otherwise("changed"))

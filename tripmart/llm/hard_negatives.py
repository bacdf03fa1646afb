"""Hard negatives by exact integer scores: a matrix product in a residue number system, then selection by window.

Rows are quantised and packed in blocks of at most `block` rows, stored once. Scores of a set of anchors against a block
are computed modulo as many small primes as the largest possible score needs: for each prime the residues of both sides,
taken around zero, are multiplied as float32 matrices, in strips of the inner dimension so short that no sum passes 24
bits. The residues are put together to exact signed 64-bit scores by mixed radix, the constructive form of the Chinese
remainder theorem.

Anchors meet blocks in cells of an equi-join: each set of anchors goes to every block once, each block to every set
once. The first join gives every anchor its best rows of the same label, and so a window of scores per positive; the
second selects the best rows of other labels within each window. A cell sends a few rows per anchor, which are ranked
over all blocks afterwards; nothing depends on how many rows share a label, a vector or a score.

Defined results: rows whose id, label or vector is null, or whose vector holds a null or non-finite component, take no
part. Shorter vectors count as filled up with zeros; empty ones score 0. A row is not its own positive or negative, but
repeated rows of its id are rows like any other. Ties go to the smaller id, then to the label's, then to any of equal
rows. Anchors without positives, and positives without a negative in their window, have no row. An empty table gives
none. Only the columns named and those in the given expressions are read. Scores that may pass 55 bits raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import shared
from tripmart.llm.topk import matrix, quantised, usable

SCALE, POSITIVES, NEGATIVES, LOW_PERCENT, HIGH_PERCENT = 256, 5, 3, 50, 95
BLOCK, ANCHORS_PER_SET, ANCHORS_AT_ONCE = 8192, 4096, 256
# Residues of primes below 1024 lie within 511 of zero: 64 products of two stay below 2^24.
STRIP, MODULUS_LIMIT = 64, 1024

PACKED = "block bigint, n bigint, width int, norm double, keys binary, ids binary, labels binary, chosen binary, values binary"
FOUND = ("anchor_block", "anchor_key", "anchor_id", "bound", "key", "id", "label", "score")


def moduli(bound: int) -> list[int]:
    """The largest primes below the limit, so many that their product tells scores from -bound to bound apart."""
    chosen, product, candidate = [], 1, MODULUS_LIMIT - 1
    while product <= 2 * bound:
        if all(candidate % divisor for divisor in range(2, int(candidate**0.5) + 1)):
            chosen.append(candidate)
            product *= candidate
        candidate -= 2
    return chosen


def centred(values: np.ndarray, modulus: int) -> np.ndarray:
    half = modulus // 2
    return (values + half) % modulus - half


def residue_products(left: np.ndarray, right: np.ndarray, modulus: int) -> np.ndarray:
    """left @ right.T modulo a prime, by float32 products of strips."""
    a, b = centred(left, modulus).astype(np.float32), centred(right, modulus).astype(np.float32)
    total = np.zeros((len(a), len(b)), np.int64)
    for start in range(0, a.shape[1], STRIP):
        total += (a[:, start:start + STRIP] @ b[:, start:start + STRIP].T).astype(np.int64)
    return centred(total, modulus)


def exact_products(left: np.ndarray, right: np.ndarray, primes: list[int]) -> np.ndarray:
    """left @ right.T, of integers, put together from its residues digit by digit."""
    score, radix = residue_products(left, right, primes[0]), primes[0]
    for prime in primes[1:]:
        digit = centred(residue_products(left, right, prime) - score % prime, prime)
        digit = centred(digit * pow(radix, -1, prime), prime)
        # Digits lie around zero, so what is added up is the signed score itself; what passes 64 bits comes back.
        with np.errstate(over="ignore"):
            score = score + digit * np.int64(radix)
        radix *= prime
    return score


class Rows:
    """Rows of a block, in order of id and label, so that of equal scores the first counts."""

    def __init__(self, packed: dict):
        self.block = packed["block"]
        self.keys, self.ids, self.labels = (np.frombuffer(packed[name], np.int64) for name in ("keys", "ids", "labels"))
        self.chosen = np.frombuffer(packed["chosen"], bool)
        self.values = np.frombuffer(packed["values"], np.int64).reshape(len(self.ids), packed["width"])

    def packed(self, places: np.ndarray) -> dict:
        values = self.values[places]
        norm = np.square(values.astype(np.float64)).sum(axis=1).max(initial=0)
        return {"block": self.block, "n": len(places), "width": values.shape[1], "norm": float(norm), "values": values.tobytes(),
                **{name: getattr(self, name)[places].tobytes() for name in ("keys", "ids", "labels", "chosen")}}

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.values, ((0, 0), (0, width - self.values.shape[1])))


def packed_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    fields = [part.split() for part in PACKED.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(name, kinds[kind]) for name, kind in fields]))


def block_task(block: int) -> Callable:
    """Rows (id, label, chosen, q) packed; a row's key is the number of its block plus its place as read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                rows = Rows.__new__(Rows)
                rows.block = number
                rows.ids, rows.labels, rows.chosen = (
                    part.column(k).to_numpy(zero_copy_only=False).astype(kind) for k, kind in enumerate((np.int64, np.int64, bool)))
                rows.keys = number + np.arange(len(rows.ids))
                rows.values = matrix(part.column(3), 0)
                yield packed_batch([rows.packed(np.lexsort((rows.labels, rows.ids)))])
                number += block

    return run


def anchors_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block its anchors, as a smaller one."""
    for batch in batches:
        blocks = [Rows(packed) for packed in batch.to_pylist()]
        yield packed_batch([rows.packed(np.flatnonzero(rows.chosen)) for rows in blocks if rows.chosen.any()])


def best_places(score: np.ndarray, fit: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of the k best fitting places of each row, best first, ties to the first column."""
    lowest = np.iinfo(np.int64).min
    left = np.where(fit, score, lowest)
    every = np.arange(len(left))
    for _ in range(k if left.shape[1] else 0):
        best = left.argmax(axis=1)
        there = left[every, best] > lowest
        if not there.any():
            return
        yield every[there], best[there]
        left[every[there], best[there]] = lowest


Found = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def positives(score: np.ndarray, anchors: Rows, at: np.ndarray, rows: Rows, k: int) -> Found:
    """(anchor, row, bound) of the best other rows of the anchor's label; there is no bound."""
    fit = (anchors.labels[at][:, None] == rows.labels) & (anchors.keys[at][:, None] != rows.keys)
    for anchor, row in best_places(score, fit, k):
        yield anchor, row, np.zeros(len(anchor), np.int64)


def negatives(score: np.ndarray, anchors: Rows, at: np.ndarray, rows: Rows, k: int, bounds: Bounds, percents: tuple[int, int]) -> Found:
    """The same of rows of other labels, for the window of each positive; bound is the positive's score."""
    other = anchors.labels[at][:, None] != rows.labels
    for bound, given in zip(bounds.scores[at].T, bounds.given[at].T, strict=True):
        least, most = -(-percents[0] * bound // 100), percents[1] * bound // 100
        fit = other & given[:, None] & (score >= least[:, None]) & (score <= most[:, None])
        for anchor, row in best_places(score, fit, k):
            yield anchor, row, bound[anchor]


class Bounds:
    """The distinct scores of each anchor's positives: as many columns as the most any anchor has."""

    def __init__(self, anchors: Rows, keys: list[int], scores: list[int]):
        order = np.argsort(anchors.keys)
        places = order[np.searchsorted(anchors.keys, np.array(keys, np.int64), sorter=order)]
        by_place = np.argsort(places, kind="stable")
        places = places[by_place]
        nth = np.arange(len(places)) - np.searchsorted(places, places)
        self.scores = np.zeros((len(anchors.keys), int(nth.max(initial=-1)) + 1), np.int64)
        self.given = np.zeros(self.scores.shape, bool)
        self.scores[places, nth] = np.array(scores, np.int64)[by_place]
        self.given[places, nth] = True


def cell_task(primes: list[int], width: int, k: int, percents: tuple[int, int] | None = None) -> Callable:
    """Best rows of a cell's blocks for each of its anchors: positives, or negatives if windows are given."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in FOUND]
        for block in right.to_pylist():
            rows = Rows(block)
            block_values = rows.widened(width)
            for packed in left.to_pylist():
                anchors = Rows(packed)
                anchor_values = anchors.widened(width)
                bounds = Bounds(anchors, packed["bound_keys"], packed["bound_scores"]) if percents else None
                for start in range(0, len(anchors.ids), ANCHORS_AT_ONCE):
                    at = np.arange(start, min(start + ANCHORS_AT_ONCE, len(anchors.ids)))
                    score = exact_products(anchor_values[at], block_values, primes)
                    best = (negatives(score, anchors, at, rows, k, bounds, percents) if bounds
                            else positives(score, anchors, at, rows, k))
                    for anchor, row, bound in best:
                        own = at[anchor]
                        columns = (np.full(len(own), anchors.block), anchors.keys[own], anchors.ids[own], bound,
                                   rows.keys[row], rows.ids[row], rows.labels[row], score[anchor, row])
                        for parts, values in zip(found, columns, strict=True):
                            parts.append(values)
        return pa.table(dict(zip(FOUND, map(np.concatenate, found), strict=True)))

    return run


def first_of(frame: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "label", "key")
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, id_column: str = "vec_id", vector_column: str = "embedding",
    label: Column | None = None, scale: int = SCALE, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
    percents: tuple[int, int] = (LOW_PERCENT, HIGH_PERCENT), block: int = BLOCK, anchors_per_set: int = ANCHORS_PER_SET,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its best
    rows of the same label, the best rows of other labels whose score is within the percents of the positive's.
    `label`: an integer expression, the column of that name unless given."""
    vector = F.col(vector_column)
    columns = [F.col(id_column).cast("bigint").alias("id"), (F.col("label") if label is None else label).cast("bigint").alias("label"),
               F.coalesce(is_anchor, F.lit(False)).alias("chosen"), quantised(vector, scale).alias("q")]
    rows = vectors.where(usable(vector)).select(*columns).where("id IS NOT NULL AND label IS NOT NULL")
    blocks = shared(rows.mapInArrow(block_task(block), PACKED))
    anchors = shared(blocks.mapInArrow(anchors_only, PACKED))
    measures = blocks.agg(F.count("*"), F.max("norm"), F.max("width")).first()
    sets = -(-anchors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // anchors_per_set)
    if not sets:
        return rows.where(F.lit(False)).select(
            F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(0).alias("rank"),
            F.col("id").alias("negative_id"), F.col("id").alias("positive_score"), F.col("id").alias("negative_score"))
    slots, norm, width = measures
    # No score passes the largest squared length. It is rounded up, as its sum was of doubles.
    bound = int(norm * (1 + 1e-9)) + 1
    if bound * max(100, *percents) >= 1 << 62:
        raise ValueError(f"scores up to {bound} do not fit")
    primes = moduli(bound)
    slot = F.pmod(F.xxhash64("block"), F.lit(slots))
    in_cells = blocks.withColumns({"slot": slot, "set": F.explode(F.sequence(F.lit(0), F.lit(sets - 1)))}).groupBy("set", "slot")

    def searched(some: DataFrame, task: Callable) -> DataFrame:
        to_all = some.withColumns({"set": F.pmod(F.xxhash64("block"), F.lit(sets)).cast("int"),
                                   "slot": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint")))})
        return to_all.groupBy("set", "slot").cogroup(in_cells).applyInArrow(task, ", ".join(f"{name} bigint" for name in FOUND))

    best = shared(first_of(searched(anchors, cell_task(primes, width, n_positives)), ["anchor_key"], n_positives))
    given = best.groupBy(F.col("anchor_block").alias("block")).agg(
        F.collect_set(F.struct("anchor_key", "score")).alias("bounds"))
    bounded = anchors.join(given, "block").select(
        anchors["*"], F.col("bounds.anchor_key").alias("bound_keys"), F.col("bounds.score").alias("bound_scores"))
    hard = first_of(searched(bounded, cell_task(primes, width, n_negatives, percents)), ["anchor_key", "bound"], n_negatives)
    mined = best.select("anchor_key", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("bound")).join(
        hard.select("anchor_key", "bound", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")),
        ["anchor_key", "bound"])
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", F.col("bound").alias("positive_score"), "negative_score")

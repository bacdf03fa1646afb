"""Removal of long repeated byte strings, by hash names at anchors that the content chooses.

This stands in place of induced sorting of suffixes: nothing is sorted as a suffix and no order is induced, as repeats
are asked for and not their order. A position is an anchor (a sample) where a 16-byte hash is the smallest (leftmost)
among 256 neighbours, about one position in 128. Where a sample falls depends on the bytes around it alone, so equal
strings of `length` bytes have their samples at equal offsets, and every string start belongs to exactly one sample (it
is `offset` bytes before it).

Tuples are counted by Spark's aggregations, which spill to disk in every task; no task holds a shard. Tuples carry names
(hashes) instead of bytes, and the name of their common prefix:

  level 0    offsets of a sample together   common prefix: the bytes all strings of the sample share
  level 1    16 offsets                     ″
  level 2    one offset                     the whole string

At each level, tuples of equal name occur more than once, so all strings they cover do: they are done. Tuples whose
common prefix meets no other tuple are unique: done too. Only tuples that share a common prefix but not a name go
down a level, carrying their bytes. The result is exact up to 128-bit hashes.

Defined results: null texts are empty. Texts shorter than `length` lose nothing. Copies of a text (repeated rows
included) repeat one another and are emptied. Work is kept per distinct text, so ids may repeat or be null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.bitmap import BitMap
from tripmart.llm.common import shared, text_key
from tripmart.llm.tokens import MULTIPLIER, as_long, byte_values, mixed, powers, text_parts

LENGTH = 400
GRAM = 16
NEIGHBOURS = 256
STEP = 16
MAP_BITS = 25
PIECE = 1 << 20
LOW = np.uint64(0xFFFFFFFF)


def pieces(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, bytes of that row before them). A long text comes in pieces that overlap by
    length - 1 bytes, so that each string start is in one piece only."""
    for start, _, data, offsets in text_parts(column, PIECE):
        if len(offsets) > 2 or len(data) <= PIECE:
            yield start, data, offsets, 0
            continue
        for base in range(0, len(data), PIECE):
            part = data[base:base + PIECE + length - 1]
            yield start, part, np.array([0, len(part)]), base


class Names:
    """Names of any ranges of at least 8 bytes, each in constant time."""

    def __init__(self, data: np.ndarray) -> None:
        grams = byte_values()[data]
        for step in (1, 2, 4):
            grams = grams[:-step] * np.uint64(pow(MULTIPLIER, step, 1 << 64)) + grams[step:]
        self.grams = grams
        up, self.down = powers(len(grams))
        self.first = np.concatenate(([np.uint64(0)], np.cumsum(mixed(grams) * up, dtype=np.uint64)))
        self.second = np.concatenate(([np.uint64(0)], np.cumsum(mixed(grams + np.uint64(7)) * up, dtype=np.uint64)))

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray, also: np.ndarray) -> np.ndarray:
        """also: numbers that must be equal too, as part of the name."""
        return mixed((sums[end - 7] - sums[start]) * self.down[start] + mixed(also.astype(np.uint64)))


def samples(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[Names, np.ndarray, np.ndarray, np.ndarray]:
    """(names, sample, first start, last start): the string starts that belong to each sample."""
    names = Names(data)
    grams = names.grams[:-8] * np.uint64(pow(MULTIPLIER, 8, 1 << 64)) + names.grams[8:]
    least = (mixed(grams) & ~LOW) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < NEIGHBOURS:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    starts_here = np.zeros(len(data) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(starts_here, offsets[long], 1)
    np.add.at(starts_here, offsets[long + 1] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(starts_here[:-1]))
    sample = (least[at] & LOW).astype(np.int64)
    turn = np.flatnonzero((np.diff(sample) != 0) | (np.diff(at) != 1))
    first, last = np.concatenate(([0], turn + 1)), np.concatenate((turn, [len(at) - 1]))
    return names, sample[first], at[first], at[last]


def prefix_task(length: int) -> Callable:
    """(prefix, n): how often each common prefix of a sample occurs among texts taken together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets, _ in pieces(batch.column(0), length):
                if (np.diff(offsets) >= length).any():
                    names, sample, _, _ = samples(data, offsets, length)
                    prefix = names.of(names.first, sample, sample + length - NEIGHBOURS + 1, np.zeros(len(sample)))
                    prefix, n = np.unique(prefix, return_counts=True)
                    yield pa.RecordBatch.from_arrays([as_long(prefix), pa.array(n.astype(np.int64))], ["prefix", "n"])

    return run


def tuple_task(length: int, wanted: BitMap) -> Callable:
    """Level-0 tuples of the samples whose common prefix may occur elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets, base in pieces(batch.column(1), length):
                if not (np.diff(offsets) >= length).any():
                    continue
                names, sample, first, last = samples(data, offsets, length)
                prefix = names.of(names.first, sample, sample + length - NEIGHBOURS + 1, np.zeros(len(sample)))
                kept = wanted.has(prefix)
                prefix, sample, first, last = prefix[kept], sample[kept], first[kept], last[kept]
                shape = (sample - first) * 65536 + (sample - last)
                doc = np.searchsorted(offsets, sample, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [as_long(prefix), as_long(names.of(names.first, first, last + length, shape)),
                     as_long(names.of(names.second, first, last + length, shape)),
                     batch.column(0).take(pa.array(row + doc)), pa.array(sample - offsets[doc] + base),
                     pa.array((sample - last).astype(np.int32)), pa.array((sample - first).astype(np.int32))],
                    ["prefix", "name1", "name2", "key", "at", "low", "high"])

    return run


TUPLE = "prefix bigint, name1 bigint, name2 bigint, key binary, at bigint, low int, high int"


def context_task(length: int) -> Callable:
    """From (key, text, wanted tuples of that text) to one row per tuple with the bytes it covers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, lists = batch.columns
            rows: list[dict] = []
            for key, text, wanted in zip(keys, texts, lists, strict=True):
                data, key = text.as_buffer(), key.as_py()
                for one in wanted.as_py():
                    start, end = one["at"] - one["high"], one["at"] - one["low"] + length
                    rows.append(one | {"key": key, "bytes": data[start:end].to_pybytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("key", pa.binary()), ("at", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
                    ("n", pa.int64()), ("bytes", pa.binary())]))

    return run


CONTEXT = "key binary, at bigint, low int, high int, n bigint, bytes binary"


def level_task(length: int, step: int) -> Callable:
    """Tuples of `step` offsets each, from rows (key, at, low, high, n, bytes, base: offset where bytes begin)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_parts(batch.column(5), PIECE):
                low, high, base = (batch.column(k).slice(start, end - start).to_numpy().astype(np.int64) for k in (2, 3, 6))
                names = Names(data)
                block_first, blocks = low // step, high // step - low // step + 1
                row = np.repeat(np.arange(end - start), blocks)
                block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks) + block_first[row]
                lows, highs = np.maximum(low[row], step * block), np.minimum(high[row], step * block + step - 1)
                sample = offsets[row] + base[row]
                shape = highs * 65536 + lows
                common = sample - step * block
                none = np.zeros(len(row))
                take = pa.array(start + row)
                yield pa.RecordBatch.from_arrays(
                    [as_long(names.of(names.first, common, common - step + 1 + length, none)),
                     as_long(names.of(names.first, sample - highs, sample - lows + length, shape)),
                     as_long(names.of(names.second, sample - highs, sample - lows + length, shape)),
                     batch.column(0).take(take), batch.column(1).take(take), pa.array(lows.astype(np.int32)),
                     pa.array(highs.astype(np.int32)), batch.column(4).take(take)],
                    ["prefix", "name1", "name2", "key", "at", "low", "high", "n"])

    return run


def level(contexts: DataFrame, length: int, step: int) -> DataFrame:
    rows = contexts.select("key", "at", "low", "high", "n", "bytes", "base")
    return rows.mapInArrow(level_task(length, step), TUPLE + ", n bigint")


def mixed_tuples(named: DataFrame) -> DataFrame:
    """One tuple for each name whose common prefix has further names; n: how often the name occurs."""
    shared_prefix = named.groupBy("prefix").agg(F.count(F.lit(1)).alias("names")).where(F.col("names") > 1)
    return named.join(shared_prefix.select("prefix"), "prefix").select("one.*", "n")


def named_tuples(tuples: DataFrame, n) -> DataFrame:
    return tuples.groupBy("prefix", "name1", "name2").agg(
        F.sum(n).alias("n"), F.min(F.struct("key", "at", "low", "high")).alias("one")
    )


def spans_of(tuples: DataFrame, length: int) -> DataFrame:
    return tuples.select(
        "key", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end")
    )


def repeated_spans(docs: DataFrame, text_column: str, length: int) -> DataFrame:
    """(key, start, end) of strings that occur more than once; spans overlap, and together are all of them."""
    if length < NEIGHBOURS + 2 * GRAM:
        raise ValueError(f"strings must have {NEIGHBOURS + 2 * GRAM} bytes at least")
    texts = docs.select(text_key(F.col(text_column)).alias("key"), F.col(text_column).alias("text"))
    prefixes = texts.select("text").mapInArrow(prefix_task(length), "prefix bigint, n bigint")
    common = prefixes.groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    tuples = shared(texts.mapInArrow(tuple_task(length, BitMap.of(common, "prefix", MAP_BITS)), TUPLE))
    named = shared(named_tuples(tuples, F.lit(1)))
    names = ["prefix", "name1", "name2"]
    found = [spans_of(tuples.join(named.where(F.col("n") > 1).select(*names), names, "left_semi"), length)]

    unclear = shared(mixed_tuples(named))
    holders = BitMap.of(unclear.select(F.xxhash64("key").alias("holder")), "holder", MAP_BITS)
    wanted = unclear.groupBy("key").agg(F.collect_list(F.struct("at", "low", "high", "n")).alias("wanted"))
    contexts = shared(
        flagged(texts, holders).where(F.col("flag")).groupBy("key").agg(F.max("text").alias("text"))
        .join(wanted, "key").select("key", "text", "wanted")
        .mapInArrow(context_task(length), CONTEXT)
    )
    ones = F.col("n") == 1
    base = F.col("high").alias("base")
    blocks = level(contexts.select("*", base), length, STEP)
    named_blocks = shared(named_tuples(blocks, F.col("n")))
    repeats = named_blocks.where(F.col("n") > 1).select(*names)
    found.append(spans_of(blocks.where(ones).join(repeats, names, "left_semi"), length))

    still = mixed_tuples(named_blocks).withColumnRenamed("n", "times")
    # A sample whose strings start on both sides of a cut between pieces has a context for each side.
    within = F.col("low").between(F.col("least"), F.col("base")) & (F.col("high") <= F.col("base"))
    narrowed = still.join(
        contexts.select("key", "at", F.col("low").alias("least"), F.col("high").alias("base"), "bytes"), ["key", "at"]
    ).where(within).select("key", "at", "low", "high", F.col("times").alias("n"), "bytes", "base")
    strings = level(narrowed, length, 1)
    repeats = named_tuples(strings, F.col("n")).where(F.col("n") > 1).select(*names)
    found.append(spans_of(strings.where(ones).join(repeats, names, "left_semi"), length))
    return found[0].unionByName(found[1]).unionByName(found[2])


def flagged(texts: DataFrame, members: BitMap) -> DataFrame:
    """The rows with a column flag: whether the key may be a member."""
    schema = texts.withColumn("flag", F.lit(True)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(batch.num_columns - 1).to_numpy().astype(np.int64).view(np.uint64)
            flags = pa.array(members.has(hashes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], flags], [*batch.schema.names[:-1], "flag"])

    return texts.withColumn("hash_", F.xxhash64("key")).mapInArrow(run, schema)


def removal_task() -> Callable:
    """(row, key, text, spans) to the merged spans and what is left of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(1), batch.column(2)
            merged_spans, left, sizes = [], [], []
            for text, spans in zip(texts, lists, strict=True):
                data = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
                merged: list[list[int]] = []
                for one in sorted((x["start"], x["end"]) for x in spans.as_py() or ()):
                    if merged and one[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], one[1])
                    else:
                        merged.append(list(one))
                edges = [0, *[edge for span in merged for edge in span], data.size]
                parts = zip(edges[::2], edges[1::2], strict=True)
                left.append(b"".join(data[start:end].to_pybytes() for start, end in parts))
                merged_spans.append([{"start": start, "end": end} for start, end in merged])
                sizes.append(data.size)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(merged_spans, span), pa.array(left, pa.binary())],
                ["row", "n_bytes", "spans", "kept"])

    return run


def remove_repeated_strings(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per input row: row (its id), n_bytes, spans (removed, merged, as byte offsets), kept (bytes left)."""
    spans = repeated_spans(docs, text_column, length)
    merged = shared(spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    holders = BitMap.of(merged.select(F.xxhash64("key").alias("holder")), "holder", MAP_BITS)
    rows = docs.select(F.col(id_column).alias("row"), F.col(text_column).alias("text"),
                       text_key(F.col(text_column)).alias("key"))
    marked = flagged(rows, holders)
    row_type = docs.schema[id_column].dataType.simpleString()
    touched = (
        marked.where(F.col("flag")).join(merged, "key", "left").select("row", "text", "spans")
        .mapInArrow(removal_task(), f"row {row_type}, n_bytes bigint, "
                    "spans array<struct<start:bigint,end:bigint>>, kept binary")
    )
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    untouched = marked.where(~F.col("flag")).select(
        "row", F.length(whole).cast("bigint").alias("n_bytes"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), whole.alias("kept"),
    )
    return touched.unionByName(untouched)

"""Benchmark decontamination by a positional inverted index of the training text.

1. Benchmark items become windows of `width` consecutive words (shorter items: one window), one row per distinct window.
2. One pass over the documents counts how often each benchmark word occurs in them.
3. A second pass stores postings (word, text, position, and the words around it) of the rarest word of each window,
   already intersected with the offset-adjusted list of its second rarest word.
4. Postings join windows on the rarest word; the remaining words are compared at their offsets. What is left are exact
   phrase matches or, with `slop`, proximity matches: stretches of at most `slop` words more than the window has, which
   begin and end with words of the window and hold every word as often as the window does. Every stretch counts.

Tasks know which words to keep from two bit maps of fixed size (512 KB each). Bit collisions only store postings that
the join drops; a larger benchmark fills the maps and costs speed, never rows. Hot words and copies: counts combine
within tasks, the joins are equi-joins that adaptive execution splits, and matches are kept per distinct text.

Defined results: null texts have no words. Items without words have no window. Repeated items or windows count once;
an item with null id can hit words but is not listed. Each input row gets one output row. Words are compared by 64-bit
hashes, whole windows therefore by 640 bits. Very long texts are taken whole. Without items nothing matches; without
documents there are no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.bitmap import BitMap
from tripmart.llm.common import shared, text_key
from tripmart.llm.tokens import as_long, mixed, text_parts, word_bytes, word_hashes

WIDTH = 10
MAP_BITS = 22


def pair_hash(rare: np.ndarray, other: np.ndarray, gap: np.ndarray | np.uint64) -> np.ndarray:
    return mixed(rare * np.uint64(3) + mixed(other + gap))


def as_hash(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64).view(np.uint64)


def item_words(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes()
        for batch in batches:
            for start, end, data, offsets in text_parts(batch.column(1)):
                hashes, bounds = word_hashes(data, offsets, table)
                terms = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), as_long(hashes))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), terms], ["item", "terms"])

    kept = items.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    return kept.mapInArrow(run, "item string, terms array<bigint>")


def item_windows(words: DataFrame, width: int) -> DataFrame:
    """(item, window) for every window of every item; the window is its words' hashes."""
    n = F.size("terms")
    starts = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array(F.lit(1)))
    return (
        words.where(n > 0)
        .select("item", "terms", F.explode(starts).alias("at"))
        .select("item", F.slice("terms", F.col("at"), F.least(F.size("terms"), F.lit(width))).alias("window"))
        .distinct()
    )


def word_counts(docs: DataFrame, text_column: str, wanted: BitMap) -> DataFrame:
    """How often each word occurs whose bit is set, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes()
        for batch in batches:
            for _, _, data, offsets in text_parts(batch.column(0)):
                hashes, _ = word_hashes(data, offsets, table)
                terms, counts = np.unique(hashes[wanted.has(hashes)], return_counts=True)
                yield pa.RecordBatch.from_arrays([as_long(terms), pa.array(counts.astype(np.int64))], ["term", "n"])

    counted = docs.select(F.col(text_column).alias("text")).mapInArrow(run, "term bigint, n bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def posting_task(width: int, slop: int, rare: BitMap, pairs: BitMap) -> Callable:
    radius = width - 1 + slop
    ordered = slop == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes()
        for batch in batches:
            for start, end, data, offsets in text_parts(batch.column(1)):
                hashes, bounds = word_hashes(data, offsets, table)
                keys = batch.column(0).slice(start, end - start)
                n_words = np.diff(bounds)
                none = pa.nulls(end - start, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(n_words.astype(np.int64)), none, none, pa.nulls(end - start, pa.list_(pa.int64())),
                     batch.column(2).slice(start, end - start)],
                    ["key", "n_words", "term", "at", "around", "row"])
                found = np.flatnonzero(rare.has(hashes))
                doc = np.searchsorted(bounds, found, "right") - 1
                near = np.zeros(len(found), bool)
                for gap in range(-radius, radius + 1):
                    other = found + gap
                    fits = (other >= bounds[doc]) & (other < bounds[doc + 1])
                    pair = pair_hash(hashes[found[fits]], hashes[other[fits]],
                                     np.uint64(gap & 0xFFFF if ordered else 0))
                    near[fits] |= pairs.has(pair)
                found, doc = found[near], doc[near]
                if not len(found):
                    continue
                place = found[:, None] + np.arange(-radius, radius + 1)
                fits = (place >= bounds[doc][:, None]) & (place < bounds[doc + 1][:, None])
                around = np.where(fits, hashes[np.clip(place, 0, len(hashes) - 1)], np.uint64(0)).reshape(-1)
                steps = np.arange(len(found) + 1, dtype=np.int32) * (2 * radius + 1)
                none = pa.nulls(len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(doc)), none, as_long(hashes[found]), pa.array(found - bounds[doc]),
                     pa.ListArray.from_arrays(pa.array(steps), as_long(around)),
                     pa.nulls(len(found), batch.column(2).type)],
                    ["key", "n_words", "term", "at", "around", "row"])

    return run


def pair_hashes(windows: DataFrame, ordered: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, other, gap = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            gap = (gap & 0xFFFF).astype(np.uint64) if ordered else np.zeros(len(rare), np.uint64)
            yield pa.RecordBatch.from_arrays([as_long(pair_hash(as_hash(rare), as_hash(other), gap))], ["pair"])

    gap = (F.col("second_at") - F.col("rare_at")).cast("bigint")
    return windows.select("rare", "second", gap.alias("gap")).mapInArrow(run, "pair bigint")


class Matches:
    """Index pass over the documents, and what matched. documents: row, key, n_words of every input row;
    matches: key, start, length, window of every match in a distinct text; windows: window, item."""

    def __init__(self, documents: DataFrame, matches: DataFrame, windows: DataFrame) -> None:
        self.documents, self.matches, self.windows = documents, matches, windows


def find_matches(
    docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", width: int = WIDTH, slop: int = 0,
) -> Matches:
    """Every occurrence of every window of the items in the documents."""
    windows = shared(item_windows(item_words(items, item_column, item_text), width))
    distinct = windows.select("window").distinct()
    placed = distinct.select("window", F.posexplode("window").alias("at", "term"))
    counts = word_counts(docs, text_column, BitMap.of(placed, "term", MAP_BITS))
    ranked = F.array_sort(F.collect_list(F.struct("n", "at", "term")))
    # A window holds `width` words at most, so the lists are short. A word that occurs nowhere has no count: its
    # windows lose a word here, and cannot occur.
    probes = (
        placed.join(counts, "term").groupBy("window").agg(ranked.alias("words"))
        .where(F.size("words") == F.size("window"))
        .select(
            "window",
            F.col("words")[0]["term"].alias("rare"), F.col("words")[0]["at"].alias("rare_at"),
            F.coalesce(F.get("words", F.lit(1))["term"], F.col("words")[0]["term"]).alias("second"),
            F.coalesce(F.get("words", F.lit(1))["at"], F.col("words")[0]["at"]).alias("second_at"),
        )
    )
    probes = shared(probes)
    task = posting_task(width, slop, BitMap.of(probes, "rare", MAP_BITS),
                        BitMap.of(pair_hashes(probes, slop == 0), "pair", MAP_BITS))
    indexed = shared(
        docs.select(text_key(F.col(text_column)).alias("key"), F.col(text_column).alias("text"),
                    F.col(id_column).alias("row"))
        .mapInArrow(task, "key binary, n_words bigint, term bigint, at bigint, around array<bigint>, row "
                    + docs.schema[id_column].dataType.simpleString())
    )
    radius = width - 1 + slop
    candidates = (
        indexed.where(F.col("term").isNotNull()).select("term", "key", "at", "around").distinct()
        .join(probes.select(F.col("rare").alias("term"), "rare_at", "window"), "term")
    )
    length = F.size("window")
    if slop == 0:
        matched = candidates.where(F.slice("around", radius + 1 - F.col("rare_at"), length) == F.col("window"))
        matched = matched.select("key", (F.col("at") - F.col("rare_at")).alias("start"), length.alias("length"), "window")
    else:
        span = length + slop
        inside = lambda word: F.array_contains("window", word)
        often = lambda words, term: F.size(F.filter(words, lambda word: word == term))
        # Places of `around` that lie beyond the text hold 0; they are no words and end a span.
        spans = F.transform(
            F.sequence(F.greatest(F.lit(1), radius + 2 - span), F.lit(radius + 1)),
            lambda first: F.struct(first.alias("first"), F.slice("around", first, span).alias("words")),
        )
        whole = F.filter(spans, lambda one: F.forall("window", lambda term: often(one["words"], term) >= often(F.col("window"), term)))
        ends = F.transform(whole, lambda one: F.struct(
            one["first"].alias("first"),
            F.filter(F.transform(one["words"], lambda word, at: F.when(inside(word), at)), lambda at: at.isNotNull()).alias("places")))
        matched = candidates.select("key", "at", "window", F.explode(ends).alias("one")).select(
            "key", (F.col("at") + F.col("one.first") - (radius + 1) + F.col("one.places")[0]).alias("start"),
            (F.element_at("one.places", -1) - F.col("one.places")[0] + 1).alias("length"), "window",
        )
    documents = indexed.where(F.col("n_words").isNotNull()).select("row", "key", "n_words")
    return Matches(documents, matched.distinct(), windows)


def contamination(found: Matches) -> DataFrame:
    """One row per input row: row, n_words, n_hit, n_items, items (sorted ids)."""
    covered = F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("start", "length")),
        lambda one: F.sequence(one["start"], one["start"] + one["length"] - 1),
    )))
    hits = found.matches.groupBy("key").agg(F.size(covered).cast("bigint").alias("n_hit"))
    items = (
        found.matches.select("key", "window").distinct().join(found.windows, "window")
        .groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return (
        found.documents.join(hits, "key", "left").join(items, "key", "left")
        .select(
            "row", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )

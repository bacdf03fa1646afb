"""Stupid-backoff language-model scores.

S(w | context) is count(context w) / count(context) if that n-gram occurs at least `min_count` times, else `backoff`
times the score with a context shorter by one word; single words score count / all words, whatever their count. A
document's score is the sum of the logarithms over its words.

With `by_others`, each document is scored by the model of all other documents: its own occurrences are taken off every
count, and its own words off the number of all words. Without, the text scored is part of the text counted, so every
n-gram of it has been seen and nothing ever backs off unless `min_count` is above 1. A word that no other document has
backs off once more, to `backoff` / all words.

The n-grams of a few megabytes of text (a batch) are hashed, sorted and counted together. They are sent, packed, to count
tables by hash range; a table adds up each n-gram over all batches and sends every batch the totals of its n-grams,
where they are joined to the n-grams of each document and summed. A frequent n-gram is one entry per batch, so no
range grows with its frequency, and the number of ranges follows the number of words.

Defined results: null and blank texts have no words; their score is 0 and their mean null. Repeated rows count as
often as they occur, and are other documents to one another. n-grams are told apart by 64-bit
hashes. Very long texts are a batch of their own. An empty table gives no rows. Only the two columns named are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import shared
from tripmart.llm.tokens import mixed, text_parts, word_bytes, word_hashes

ORDER, BACKOFF, MIN_COUNT = 2, 0.4, 1
RANGE_GRAMS = 1 << 20


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes by significance, compressed."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unsqueezed(blob: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    data = pa.decompress(blob, n * size, "zstd", asbytes=True) if n else b""
    return np.frombuffer(data, np.uint8).reshape(size, n).T.copy().view(kind).reshape(-1)


def batch_task() -> Callable:
    """Rows (batch, ids, bounds, n, n_vocabulary, vocabulary, words) for texts taken together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = word_bytes(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, end, data, offsets in text_parts(batch.column(1)):
                hashes, bounds = word_hashes(data, offsets, table)
                vocabulary, words = np.unique(hashes, return_inverse=True)
                ids = batch.column(0).slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     pa.array([bounds.astype(np.int64).tobytes()]), pa.array([len(hashes)]), pa.array([len(vocabulary)]),
                     pa.array([squeezed(vocabulary)]), pa.array([squeezed(words.astype(np.uint32))])],
                    ["batch", "ids", "bounds", "n", "n_vocabulary", "vocabulary", "words"])
                number += 1

    return run


def grams(row: dict, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1: the hash of the n-gram ending at every word, and whether the text has one there."""
    vocabulary = unsqueezed(row["vocabulary"], row["n_vocabulary"], np.uint64)
    single = vocabulary[unsqueezed(row["words"], row["n"], np.uint32)] if row["n"] else vocabulary
    bounds = np.frombuffer(row["bounds"], np.int64)
    place = np.arange(row["n"]) - np.repeat(bounds[:-1], np.diff(bounds))
    found = [(mixed(single), place >= 0)]
    for length in range(2, order + 1):
        shorter = found[-1][0]
        longer = mixed(np.concatenate(([np.uint64(0)], shorter[:-1])) * np.uint64(3) + mixed(single + np.uint64(length)))
        found.append((longer[:row["n"]], place >= length - 1))
    return found


def all_grams(found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.concatenate([hashes[there] for hashes, there in found])


def count_task(order: int, slot_bits: int) -> Callable:
    """(slot, batch, n, grams, counts): one row per batch and hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.unique(all_grams(grams(row, order)), return_counts=True)
                slots = (hashes >> np.uint64(64 - slot_bits)).astype(np.int64)
                edges = np.flatnonzero(np.diff(slots, prepend=-1))
                ends = [*edges[1:], len(hashes)][:len(edges)]  # no words, no ranges
                steps = np.diff(hashes, prepend=np.uint64(0))
                steps[edges] = hashes[edges]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots[edges]), pa.array([row["batch"]] * len(edges), pa.int64()),
                     pa.array(np.array(ends, np.int64) - edges),
                     pa.array([squeezed(steps[a:b]) for a, b in zip(edges, ends, strict=True)], pa.binary()),
                     pa.array([squeezed(counts[a:b].astype(np.uint32)) for a, b in zip(edges, ends, strict=True)], pa.binary())],
                    ["slot", "batch", "n", "grams", "counts"])

    return run


def total_counts(table: pa.Table) -> pa.Table:
    """Of one hash range: for every batch, the totals of its n-grams, in the order it sent them."""
    rows = table.select(["n", "grams", "counts"]).to_pylist()
    hashes = np.concatenate([np.cumsum(unsqueezed(r["grams"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
    counts = np.concatenate([unsqueezed(r["counts"], r["n"], np.uint32) for r in rows])
    distinct, at = np.unique(hashes, return_inverse=True)
    totals = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.uint64)[at]
    ends = np.cumsum([r["n"] for r in rows])
    blobs = [squeezed(part) for part in np.split(totals, ends[:-1])]
    return pa.table({"slot": table.column("slot"), "batch": table.column("batch"), "n": table.column("n"),
                     "totals": pa.array(blobs, pa.binary())})


def own_counts(at: np.ndarray, there: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each n-gram (its number in `at`), how often it is in its own text; 0 where there is none."""
    own = np.zeros(len(at))
    if there.any():
        pairs = text[there] * (int(at.max()) + 1) + at[there]
        _, which, n = np.unique(pairs, return_inverse=True, return_counts=True)
        own[there] = n[which]
    return own


def score_task(order: int, backoff: float, min_count: int, all_words: int, by_others: bool) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.sort_by("slot").to_pylist()
        totals = np.concatenate([np.zeros(0, np.uint64), *[unsqueezed(r["totals"], r["n"], np.uint64) for r in rows]])
        out = []
        for row in left.to_pylist():
            found = grams(row, order)
            distinct = np.unique(all_grams(found))
            numbers = [np.searchsorted(distinct, hashes).clip(0, max(0, len(distinct) - 1)) for hashes, _ in found]
            count = [np.where(there, totals[at] if len(totals) else 0, 0).astype(np.float64)
                     for at, (_, there) in zip(numbers, found, strict=True)]
            bounds = np.frombuffer(row["bounds"], np.int64)
            sizes, counted = np.diff(bounds), max(1, all_words)
            if by_others:
                text = np.repeat(np.arange(len(sizes)), sizes)
                count = [n - own_counts(at, there, text) for n, at, (_, there) in zip(count, numbers, found, strict=True)]
                counted = np.maximum(1, all_words - sizes)[text]
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(count[0] > 0, np.log(count[0] / counted), np.log(backoff / counted))
                for length in range(2, order + 1):
                    context = np.concatenate(([1.0], count[length - 2][:-1]))[:row["n"]]
                    longer = np.log(count[length - 1] / context)
                    here = found[length - 1][1]
                    score = np.where(here, np.where(count[length - 1] >= min_count, longer, np.log(backoff) + score), score)
            sums = np.add.reduceat(np.append(score, 0.0), bounds[:-1]) if len(bounds) > 1 else np.zeros(0)
            out.append(pa.table({"row": pa.array(row["ids"], left.schema.field("ids").type.value_type),
                                 "n_words": pa.array(sizes), "log_score": pa.array(np.where(sizes > 0, sums, 0.0))}))
        return pa.concat_tables(out)

    return run


def language_model_scores(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER,
    backoff: float = BACKOFF, min_count: int = MIN_COUNT, by_others: bool = False,
) -> DataFrame:
    """One row per document: row (its id), n_words, log_score, mean_log_score, by n-gram counts over all documents or,
    with `by_others`, over all but the one scored."""
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("row"), F.col(text_column).alias("text"))
    batches = shared(texts.mapInArrow(
        batch_task(), f"batch bigint, ids array<{id_type}>, bounds binary, n bigint, n_vocabulary bigint, "
        "vocabulary binary, words binary"))
    all_words = batches.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slot_bits = max(4, (max(1, order * all_words // RANGE_GRAMS) - 1).bit_length())
    sent = batches.mapInArrow(count_task(order, slot_bits), "slot bigint, batch bigint, n bigint, grams binary, counts binary")
    totals = sent.groupBy("slot").applyInArrow(total_counts, "slot bigint, batch bigint, n bigint, totals binary")
    scored = batches.groupBy("batch").cogroup(totals.groupBy("batch")).applyInArrow(
        score_task(order, backoff, min_count, all_words, by_others), f"row {id_type}, n_words bigint, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))

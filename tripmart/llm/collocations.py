"""Collocations by stripes: each prefix keys a counter of the words that follow it.

Texts are cut into pieces and words, and every word occurrence adds one to two stripes: that of the empty prefix, under
the word, and that of the word and its successor, under the word after; where a piece ends, its end counts as a word.
So one structure has every count: of words as entries of the empty prefix, of pairs as totals of the two-word prefixes,
of triples as their entries (the extensions), and the largest extension of each pair, which decides its subsumption.

The stripes of a few megabytes of text are built together in memory, packed by bucket (a hash of the prefix), and the
stripes of a bucket are merged elementwise in one task. Words travel as text, so counts are exact, not up to hashes. A
frequent phrase is one entry per batch. The stripe of a frequent prefix would still be long: the empty one is spread by
next word over all buckets, and a first pass finds every two-word prefix that may hold over 2 / `hot` of all words; these
are at most `hot` by arithmetic, whatever the corpus, and each is spread over parts by next word in proportion.

The number of buckets follows the number of words. A bucket's size grows with the square root of it, beyond
`bucket_words`, so that what a batch sends to a bucket stays worth packing on large tables too.

Defined results: null and empty texts have no words. Documents whose language is null count as the language `und`.
Repeated rows count as often as they occur, ids are not read. Texts of any length are taken whole. Ties go to the
larger count, then to the smaller phrase by UTF-8 bytes. An empty table gives no rows. Only the two columns named are
read. Counts are exact up to 10^15, and so are scores.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import stored
from tripmart.llm.lm_score import squeezed, unsqueezed
from tripmart.llm.tokens import mixed, text_parts

MIN_COUNT, TOP, SUBSUMED_PERCENT, SCALE, UNKNOWN = 10, 2000, 50, 1_000_000, "und"
# Bytes of text whose stripes are built together, and words per bucket.
TOGETHER, BUCKET_WORDS, HOT = 4 << 20, 1 << 20, 1 << 14

# What separates words within a piece, and what ends a piece.
BLANKS, BREAKS = b" \t", b".,;:!?\n\v\f\r"
END = 0  # number of the word that follows the last one of a piece

PACKED = "bucket bigint, n_words bigint, words binary, lengths binary, n bigint, first binary, second binary, next binary, counts binary"
MERGED = "kind string, lang string, first string, second string, next string, n bigint, longest bigint"


def byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(BLANKS)], kinds[list(BREAKS)] = 1, 2
    return kinds


def lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def words_of(data: np.ndarray, offsets: np.ndarray, langs: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, each after its language and a tab; the number (from 1) of every occurrence; its piece."""
    kinds = byte_kinds()[data]
    inside = kinds == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    text = np.searchsorted(offsets, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kinds == 2), starts) + text
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(lowered()[data[inside]]))]).dictionary_encode()
    names = sorted(set(langs))
    lang = np.searchsorted(np.array(names, object), np.array(langs, object))[text] if len(starts) else text
    spelled = found.dictionary.to_pylist()
    # A word holds no tab, so the last one ends the language.
    both, number = np.unique(lang * max(1, len(spelled)) + found.indices.to_numpy(), return_inverse=True)
    prefixes = [name.encode() + b"\t" for name in names]
    words = [prefixes[k // len(spelled)] + spelled[k % len(spelled)] for k in both.tolist()]
    return words, number.astype(np.int64) + 1, piece


def word_hashes(words: list[bytes]) -> np.ndarray:
    """By number; 0, the end of a piece, has one too."""
    return np.array([END, *map(xxhash.xxh3_64_intdigest, words)], np.uint64)


def successors(number: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word after each occurrence and the one after that."""
    follows = np.zeros(len(number), bool)
    follows[:-1] = piece[1:] == piece[:-1]
    second = np.where(follows, np.append(number[1:], END), END)
    return second, np.where(second != END, np.append(second[1:], END), END)


def counted(first: np.ndarray, second: np.ndarray, following: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Stripes: distinct (first, second, next) in order of prefix, and the sum of each."""
    size = int(max(first.max(initial=0), second.max(initial=0), following.max(initial=0))) + 1
    prefixes, at = np.unique(first * size + second, return_inverse=True)
    entries, place, counts = np.unique(at * size + following, return_inverse=True, return_counts=True)
    if weights is not None:
        counts = np.zeros(len(entries), np.int64)
        np.add.at(counts, place, weights)
    prefix = prefixes[entries // size] if len(entries) else entries
    return prefix // size, prefix % size, entries % size, counts.astype(np.int64)


def prefix_hashes(hashes: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(hashes[first]) * np.uint64(3) + hashes[second])


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Words of (lang, text) rows, for texts taken together."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for start, end, data, offsets in text_parts(batch.column(1), TOGETHER):
            yield words_of(data, offsets, langs[start:end])


def hot_task(hot: int) -> Callable:
    """(lang, prefix, n): the words of each language, and the prefixes that hold 1 / hot of the words taken together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, number, piece in runs(batches):
            langs, lang = np.unique([word.rpartition(b"\t")[0] for word in words] or [b""], return_inverse=True)
            sizes = np.bincount(lang[number - 1], minlength=len(langs)) if len(number) else np.zeros(len(langs), int)
            second, _ = successors(number, piece)
            pairs, n = np.unique(number * (len(words) + 1) + second, return_counts=True)
            frequent = n * hot >= len(number)
            prefixes = prefix_hashes(word_hashes(words), pairs[frequent] // (len(words) + 1), pairs[frequent] % (len(words) + 1))
            some = [(name.decode(), None, int(size)) for name, size in zip(langs, sizes, strict=True) if size]
            some += [(None, int(p), int(m)) for p, m in zip(prefixes.view(np.int64), n[frequent], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in some], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))],
                ["lang", "prefix", "n"])

    return run


def stripe_task(buckets: int, hot: np.ndarray, parts: np.ndarray) -> Callable:
    """One row per bucket and batch: its words, and the entries of its stripes by number of word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, number, piece in runs(batches):
            second, third = successors(number, piece)
            entries = counted(number, second, third)
            hashes = word_hashes(words)
            single = np.arange(1, len(words) + 1)
            none, own = np.zeros(len(words), np.int64), np.bincount(number, minlength=len(words) + 1)[1:]
            prefix = prefix_hashes(hashes, *entries[:2])
            place = mixed(prefix + spread(prefix, hashes[entries[2]], hot, parts))
            columns = [np.concatenate(pair) for pair in zip(entries, (none, none, single, own), strict=True)]
            bucket = (np.concatenate((place, mixed(hashes[single]))) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns, bucket = [column[order] for column in columns], bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1))
            for start, end in zip(edges.tolist(), [*edges[1:].tolist(), len(bucket)], strict=False):
                yield pa.RecordBatch.from_pylist([packed(int(bucket[start]), words, [c[start:end] for c in columns])],
                                                 schema=packed_schema())

    return run


def spread(prefix: np.ndarray, following: np.ndarray, hot: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """0, or the part of its prefix's stripe that a next word belongs to if the prefix is hot."""
    if not len(hot):
        return np.zeros(len(prefix), np.uint64)
    at = np.searchsorted(hot, prefix).clip(0, len(hot) - 1)
    return np.where(hot[at] == prefix, mixed(following) % parts[at], np.uint64(0))


def packed_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in PACKED.split(", "))])


def packed(bucket: int, words: list[bytes], entries: list[np.ndarray]) -> dict:
    used, at = np.unique(np.concatenate(([END], *entries[:3])), return_inverse=True)
    spelled = [words[k - 1] for k in used[1:].tolist()]
    numbers = np.split(at[1:].astype(np.uint32), 3)
    return {
        "bucket": bucket, "n_words": len(spelled), "words": pa.compress(b"".join(spelled), "zstd", asbytes=True),
        "lengths": squeezed(np.array([len(word) for word in spelled], np.uint32)), "n": len(entries[0]),
        "counts": squeezed(entries[3].astype(np.uint64)),
        **{name: squeezed(values) for name, values in zip(("first", "second", "next"), numbers, strict=True)},
    }


def unpacked(row: dict) -> tuple[pa.Array, list[np.ndarray]]:
    bounds = np.concatenate(([0], np.cumsum(unsqueezed(row["lengths"], row["n_words"], np.uint32)))).astype(np.int64)
    text = pa.decompress(row["words"], int(bounds[-1]), "zstd") if bounds[-1] else pa.py_buffer(b"")
    words = pa.Array.from_buffers(pa.large_binary(), row["n_words"], [None, pa.py_buffer(bounds), text])
    numbers = [unsqueezed(row[name], row["n"], np.uint32).astype(np.int64) for name in ("first", "second", "next")]
    return words, [*numbers, unsqueezed(row["counts"], row["n"], np.uint64).astype(np.int64)]


def merge_task(min_count: int, hot: np.ndarray) -> Callable:
    """Merges the stripes of one bucket. Frequent words, pairs and triples; of a hot prefix every part of its total."""
    def run(table: pa.Table) -> pa.Table:
        packs = [unpacked(row) for row in table.to_pylist()]
        together = pa.chunked_array([words for words, _ in packs], pa.large_binary()).combine_chunks().dictionary_encode()
        numbers = together.indices.to_numpy().astype(np.int64) + 1
        ends = np.cumsum([len(words) for words, _ in packs])
        own = [np.concatenate(([END], part)) for part in np.split(numbers, ends[:-1])]
        columns = [np.concatenate([o[e[k]] for o, (_, e) in zip(own, packs, strict=True)]) for k in range(3)]
        first, second, following, counts = counted(*columns, np.concatenate([e[3] for _, e in packs]))
        words = together.dictionary.to_pylist()
        hashes = word_hashes(words)
        edges = np.flatnonzero(np.diff(first, prepend=-1) | np.diff(second, prepend=-1))
        totals = np.add.reduceat(counts, edges) if len(edges) else counts
        longest = np.maximum.reduceat(np.where((following != END) & (counts >= min_count), counts, 0), edges) if len(edges) else counts
        f, s = first[edges], second[edges]
        is_hot = np.isin(prefix_hashes(hashes, f, s), hot)
        pairs = (f != END) & (s != END) & ((totals >= min_count) | is_hot)
        frequent = counts >= min_count
        singles, triples = frequent & (first == END), frequent & (first != END) & (following != END)
        zeros = lambda which: np.zeros(int(which.sum()), np.int64)
        return pa.concat_tables([
            rows("word", words, [zeros(singles), zeros(singles), following[singles]], counts[singles], zeros(singles)),
            rows("pair", words, [f[pairs], s[pairs], zeros(pairs)], totals[pairs], longest[pairs]),
            rows("triple", words, [first[triples], second[triples], following[triples]], counts[triples], zeros(triples)),
        ])

    return run


def rows(kind: str, words: list[bytes], numbers: list[np.ndarray], n: np.ndarray, longest: np.ndarray) -> pa.Table:
    named = [[words[k - 1].decode().rpartition("\t")[::2] if k else (None, None) for k in column.tolist()] for column in numbers]
    langs = [next(lang for lang, _ in some if lang is not None) for some in zip(*named, strict=True)]
    spelled = [pa.array([word for _, word in column], pa.string()) for column in named]
    return pa.table([pa.array([kind] * len(n), pa.string()), pa.array(langs, pa.string()), *spelled, pa.array(n), pa.array(longest)],
                    names=[part.split()[0] for part in MERGED.split(", ")])


def ratio(a: Column, left: Column, right: Column) -> Column:
    """floor(a * a * scale / (left * right)), in decimals of 38 digits."""
    wide = lambda value: value.cast("decimal(16,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(SCALE).cast("decimal(7,0)"), wide(left) * wide(right)).cast("bigint")


def collocations(
    docs: DataFrame, *, lang_column: str = "lang", text_column: str = "text", min_count: int = MIN_COUNT, top: int = TOP,
    subsumed_percent: int = SUBSUMED_PERCENT, bucket_words: int = BUCKET_WORDS, hot: int = HOT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of two or three words: a is the phrase's
    count, l and r those of its parts at the cut that scores lowest, n all words of the language."""
    texts = docs.select(F.coalesce(F.col(lang_column), F.lit(UNKNOWN)).alias("lang"), F.col(text_column).alias("text"))
    run = uuid.uuid4().hex
    loads = stored(texts.mapInArrow(hot_task(hot), "lang string, prefix bigint, n bigint").groupBy("lang", "prefix").agg(
        F.sum("n").alias("n")), f"loads-{run}")
    sizes = loads.where("lang IS NOT NULL").select("lang", "n")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = loads.where(F.col("prefix").isNotNull() & (F.col("n") * hot >= total)).select("prefix", "n").collect()
    prefixes = np.array([row["prefix"] for row in frequent], np.int64).view(np.uint64)
    parts = np.array([1 + row["n"] * hot // total for row in frequent], np.uint64)
    order = np.argsort(prefixes)
    prefixes, parts = prefixes[order], parts[order]
    buckets = max(1, -(-total // max(bucket_words, 8 * isqrt(total))))
    stripes = texts.mapInArrow(stripe_task(buckets, prefixes, parts), PACKED)
    merged = stored(stripes.groupBy("bucket").applyInArrow(merge_task(min_count, prefixes), MERGED), f"stripes-{run}")

    words = merged.where("kind = 'word'").select("lang", F.col("next").alias("word"), "n")
    pairs = merged.where("kind = 'pair'").groupBy("lang", "first", "second").agg(
        F.sum("n").alias("n"), F.max("longest").alias("longest")).where(F.col("n") >= min_count)
    triples = merged.where("kind = 'triple'").select("lang", "first", "second", "next", "n")

    def word(name: str, count: str) -> DataFrame:
        return words.select("lang", F.col("word").alias(name), F.col("n").alias(count))

    def pair(first: str, second: str, count: str) -> DataFrame:
        return pairs.select("lang", F.col("first").alias(first), F.col("second").alias(second), F.col("n").alias(count))

    before = triples.groupBy("lang", F.col("second").alias("first"), F.col("next").alias("second")).agg(F.max("n").alias("before"))
    longer = F.greatest(F.col("longest"), F.coalesce("before", F.lit(0)))
    twos = pairs.join(before, ["lang", "first", "second"], "left").where(100 * longer < subsumed_percent * F.col("n"))
    twos = twos.join(word("first", "l"), ["lang", "first"]).join(word("second", "r"), ["lang", "second"]).select(
        "lang", F.concat_ws(" ", "first", "second").alias("phrase"), F.col("n").alias("a"), "l", "r",
        ratio(F.col("n"), F.col("l"), F.col("r")).alias("score"))
    cut = triples.join(word("first", "l1"), ["lang", "first"]).join(pair("second", "next", "r1"), ["lang", "second", "next"])
    cut = cut.join(pair("first", "second", "l2"), ["lang", "first", "second"]).join(word("next", "r2"), ["lang", "next"])
    scores = [ratio(F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)]
    cut = cut.withColumns({"s1": scores[0], "s2": scores[1]}).withColumn("early", F.col("s1") <= F.col("s2"))
    threes = cut.select(
        "lang", F.concat_ws(" ", "first", "second", "next").alias("phrase"), F.col("n").alias("a"),
        *[F.when(F.col("early"), F.col(f"{name}1")).otherwise(F.col(f"{name}2")).alias(out) for name, out in (("l", "l"), ("r", "r"), ("s", "score"))])
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = twos.unionByName(threes).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

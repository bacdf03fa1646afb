"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has one bit per position, set if over half the shingle hashes have it. Two fingerprints at most 2r bits
apart have a 64-bit number within r bits of both, so every distinct fingerprint emits all variants within r bits
(2,081 for r = 2) and fingerprints that emit one variant are links: at most 2r bits apart, which is verified.

Variants are sent packed and in two steps, as nearly all of them meet no other:
1. fingerprints are taken in batches; the hashes of a batch's variants are sorted, packed and sent to ranges of hashes,
   and a range tells every batch which of its hashes occur again, in the batch or elsewhere;
2. only those variants are sent whole, with their fingerprints, to the same ranges, and meet by their full 64 bits.
A variant has at most 2,081 fingerprints around it (r = 2), so no group of one variant is larger, however many copies
there are. They link to the smallest of them, never all to all, and a range keeps of its links those that connect
something, so a fingerprint gives each range one link at most. Copies collapse into their fingerprint first.
Components come from the links by iteration over edge tables.

Defined results: null and blank texts have no words and fingerprint zero, linked like any other. Fewer words than a
shingle: the whole sequence is one. Ids may repeat; null ids are never a component's id unless there is no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import own, shared, text_key
from tripmart.llm.components import smallest_reachable
from tripmart.llm.tokens import as_long, mixed

SHINGLE, BITS, SEED = 4, 4, 42
BATCH = 4096  # fingerprints whose variants are sorted together
SLOT_FINGERPRINTS = 2_000  # fingerprints' worth of variants in one range, about
# Bits of a hash beyond those that number all variants: one variant in 16,000 meets another's hash by chance.
SPARE_BITS = 14


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_of(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    hashes = np.fromiter(
        [hash_of(joined[start:end], seed) for start, end in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)],
        np.uint64, len(starts),
    )
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, text_column: str = "text", shingle: int = SHINGLE, seed: int = SEED,
                 keep: tuple = ()) -> DataFrame:
    """The kept columns and the fingerprint (bigint, 64 bits) of every row."""
    rows = docs.select(*keep, F.col(text_column).alias("text_"))
    schema = rows.drop("text_").withColumn("fingerprint", F.lit(0).cast("bigint")).schema
    names, text_at = schema.fieldNames(), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), shingle, seed) for text in batch.column(text_at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], as_long(found)], names)

    return rows.mapInArrow(run, schema)


@cache
def ball(radius: int) -> np.ndarray:
    """All 64-bit numbers with at most `radius` bits set."""
    masks = [sum(1 << bit for bit in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return np.array(masks, np.uint64)


def batch_task() -> Callable:
    """(batch, fingerprints): up to BATCH of them in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, left = TaskContext.get().partitionId() << 32, np.zeros(0, np.int64)
        for batch in batches:
            left = np.concatenate((left, batch.column(0).to_numpy()))
            while len(left) >= BATCH:
                yield batch_row(number, left[:BATCH])
                number, left = number + 1, left[BATCH:]
        if len(left):
            yield batch_row(number, left)

    return run


def batch_row(number: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([values.tobytes()])], ["batch", "fingerprints"])


@dataclass(frozen=True)
class Layout:
    """How hashes are packed: their bits, the first of which tell the range, and bytes of a step to the next hash."""

    radius: int
    hash_bits: int
    slot_bits: int
    step_bytes: int

    @classmethod
    def of(cls, fingerprints: int, radius: int) -> Layout:
        size = len(ball(radius))
        hash_bits = min(64, (max(1, fingerprints) * size).bit_length() + SPARE_BITS)
        slot_bits = max(5, (max(1, fingerprints // SLOT_FINGERPRINTS) - 1).bit_length())
        batch_bits = (min(max(1, fingerprints), BATCH) * size).bit_length()
        return cls(radius, hash_bits, slot_bits, max(1, min(8, -(-(hash_bits - batch_bits + 5) // 8))))

    def hashes(self, values: np.ndarray) -> np.ndarray:
        """Of each variant of each fingerprint, in the order of fingerprints and masks."""
        masks = ball(self.radius)
        found = np.empty((len(values), len(masks)), np.uint64)
        for start in range(0, len(values), 256):
            some = values[start:start + 256].view(np.uint64)
            found[start:start + 256] = mixed(some[:, None] ^ masks) >> np.uint64(64 - self.hash_bits)
        return found.reshape(-1)

    def packed(self, batch: int, values: np.ndarray) -> pa.RecordBatch:
        hashes = self.hashes(values)
        hashes.sort()
        below = self.hash_bits - self.slot_bits
        edges = np.searchsorted(hashes, np.arange(1 << self.slot_bits, dtype=np.uint64) << np.uint64(below))
        # A rare step that is too large for its bytes is written whole, after a mark in its place.
        mark = np.uint64((1 << 8 * self.step_bytes) - 1)
        slots, blobs = [], []
        for slot, (start, end) in enumerate(zip(edges, [*edges[1:], len(hashes)], strict=True)):
            if start == end:
                continue
            steps = np.diff(hashes[start:end], prepend=np.uint64(slot << below))
            large = steps >= mark
            planes = np.where(large, mark, steps).view(np.uint8).reshape(-1, 8)[:, :self.step_bytes]
            slots.append(slot)
            blobs.append(int(end - start).to_bytes(4, "little") + planes.T.tobytes() + steps[large].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int64()), pa.array([batch] * len(slots), pa.int64()), pa.array(blobs, pa.binary())],
            ["slot", "batch", "hashes"])

    def unpacked(self, blob: bytes, slot: int) -> np.ndarray:
        n, size = int.from_bytes(blob[:4], "little"), self.step_bytes
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :size] = np.frombuffer(blob, np.uint8, size * n, 4).reshape(size, n).T
        steps = planes.view(np.uint64).reshape(-1)
        large = np.flatnonzero(steps == (1 << 8 * size) - 1)
        steps[large] = np.frombuffer(blob, np.uint64, offset=4 + size * n)
        return np.cumsum(steps, dtype=np.uint64) + np.uint64(slot << (self.hash_bits - self.slot_bits))


def packed_task(layout: Layout) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, values in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                yield layout.packed(number, np.frombuffer(values, np.int64))

    return run


def repeated_task(layout: Layout) -> Callable:
    """Of one range: for every batch, those of its hashes that come more than once."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [layout.unpacked(blob.as_py(), key[0].as_py()) for blob in table.column("hashes")]
        hashes = np.concatenate(parts)
        hashes.sort()
        again = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
        own = [np.intersect1d(part, again) for part in parts]
        told = pa.table({"batch": table.column("batch"), "again": pa.array([part.tobytes() for part in own], pa.binary())})
        return told.filter(pa.array([len(part) > 0 for part in own], pa.bool_()))

    return run


def variant_task(layout: Layout) -> Callable:
    """(slot, variants, fingerprints): of a batch, the variants whose hash occurs again, packed by range."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"slot": [], "variants": [], "fingerprints": []}
        again = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x.as_py(), np.uint64) for x in right.column("again")]])
        again.sort()
        for blob in left.column("fingerprints") if len(again) else ():
            values = np.frombuffer(blob.as_py(), np.int64)
            hashes = layout.hashes(values)
            kept = np.flatnonzero(again[np.searchsorted(again, hashes).clip(0, len(again) - 1)] == hashes)
            kept = kept[np.argsort(hashes[kept])]
            masks = ball(layout.radius).view(np.int64)
            of = values[kept // len(masks)]
            variants = of ^ masks[kept % len(masks)]
            slots = (hashes[kept] >> np.uint64(layout.hash_bits - layout.slot_bits)).astype(np.int64)
            edges = np.flatnonzero(np.diff(slots, prepend=-1))
            for start, end in zip(edges, [*edges[1:], len(slots)], strict=True):
                out["slot"].append(int(slots[start]))
                out["variants"].append(variants[start:end].tobytes())
                out["fingerprints"].append(of[start:end].tobytes())
        return pa.table(out, pa.schema([("slot", pa.int64()), ("variants", pa.binary()), ("fingerprints", pa.binary())]))

    return run


def link_task(bits: int) -> Callable:
    """Of one range: links that connect all fingerprints that share a variant, no more than it takes."""
    def run(table: pa.Table) -> pa.Table:
        variants, of = (np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column(name)])
                        for name in ("variants", "fingerprints"))
        order = np.lexsort((of, variants))
        variants, of = variants[order], of[order]
        low = of[np.searchsorted(variants, variants, "left")]
        near = np.bitwise_count((of ^ low).view(np.uint64)) <= bits
        links = np.unique(np.stack((of, low), axis=1)[near & (of != low)], axis=0)
        root: dict[int, int] = {}

        def find(node: int) -> int:
            while (up := root.get(node, node)) != node:
                root[node] = root.get(up, up)
                node = up
            return node

        kept = []
        for a, b in links.tolist():
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                kept.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in kept], pa.int64()), "b": pa.array([b for _, b in kept], pa.int64())})

    return run


def fingerprint_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints; each is at most `bits` bits long, and they connect every two
    fingerprints that are at most `bits` bits apart, if through others."""
    if bits % 2:
        raise ValueError("the maximum distance must be even: half of it is each side's radius")
    n = distinct.count()
    layout = Layout.of(n, bits // 2)
    # Few bytes, but much work: not merged into few tasks.
    batches = shared(distinct.mapInArrow(batch_task(), "batch bigint, fingerprints binary").repartition(max(1, n // BATCH)))
    ranges = batches.mapInArrow(packed_task(layout), "slot bigint, batch bigint, hashes binary")
    repeated = ranges.groupBy("slot").applyInArrow(repeated_task(layout), "batch bigint, again binary")
    meeting = batches.groupBy("batch").cogroup(repeated.groupBy("batch")).applyInArrow(
        variant_task(layout), "slot bigint, variants binary, fingerprints binary")
    return meeting.groupBy("slot").applyInArrow(link_task(bits), "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
    bits: int = BITS, seed: int = SEED, keep: tuple = (),
) -> DataFrame:
    """One row per input row: row (its id), the kept columns, fingerprint (bigint), root (the
    component's smallest fingerprint) and component (the smallest id reachable, itself included)."""
    marked = shared(fingerprints(docs, text_column=text_column, shingle=shingle, seed=seed,
                                 keep=(F.col(id_column).alias("row"), *keep)))
    distinct = shared(marked.groupBy("fingerprint").agg(F.min("row").alias("least")))
    roots = smallest_reachable(fingerprint_links(distinct.select("fingerprint"), bits))
    classes = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = classes.groupBy("root").agg(F.min("least").alias("component"))
    named = classes.join(ids, "root").select("fingerprint", "root", "component")
    return marked.join(named, "fingerprint").select(
        "row", *[name for name in marked.columns if name not in ("row", "fingerprint")], "fingerprint", "root", "component"
    )


def one_of_each(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                bits: int = BITS, seed: int = SEED) -> DataFrame:
    """The documents without near-duplicates: of each component the row of the smallest id (null ids last) and, of
    rows with one id, the smallest text key; of equal rows one."""
    key, kept_id, kept_key = (own(name, docs.columns) for name in ("key", "kept_id", "kept_key"))
    found = near_duplicates(docs, id_column=id_column, text_column=text_column, shingle=shingle, bits=bits, seed=seed,
                            keep=(text_key(F.col(text_column)).alias("key"),))
    # Null ids sort first among structs, so the flag goes before.
    first = F.min(F.struct(F.col("row").isNull().alias("no_id"), "row", "key")).alias("first")
    stay = found.groupBy("root").agg(first).select(
        F.col("first.row").alias(kept_id), F.col("first.key").alias(kept_key))
    keyed = docs.withColumn(key, text_key(F.col(text_column)))
    same = F.col(id_column).eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key))
    return keyed.join(stay, same, "left_semi").dropDuplicates([id_column, key]).drop(key)

"""Exact top-k inner products over a stored bit-sliced index.

The index (`build_index`, a table that may be written and used again) holds blocks of rows. Of each attribute it has one
bit map over the block's rows per bit of the quantised value, above the block's smallest value of that attribute. A query
is answered within a block by bitmap arithmetic alone: the slices of all attributes, shifted by the bits of the query's
components (complemented where a component is negative), are added up by carry-save adders to the slices of the scores.
From the most significant one down, a slice splits the rows at the boundary, until the k best are certain; rows that tie
at the boundary are resolved by id. The scores of the rows found are read from the score slices, so they are exact.

Queries are packed in sets, and sets meet the blocks in one equi-join on a number of slots that blocks are dealt to: the
index is shuffled once, queries once per slot, and every set keeps its k best per query of a slot's blocks. There is
no loop, and nothing of the rows or queries reaches the driver but the number of blocks.

Defined results: vectors that are null or hold null or non-finite components take no part, as query or candidate. A
shorter vector counts as filled up with zeros. A query's candidates are all rows of other ids; repeated rows of an id
are candidates of their own, ties go to the smaller id. A repeated query row is answered once. Quantised components
may have up to 40 bits if scores stay within 64 bits. Vectors are numbers, not texts, so long ones only widen a block. An empty
table, or one without queries, gives no rows. Only the two columns named (and those of `is_query`) are read, whatever
else the table has.
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

SCALE, K, QUERY_SET, INDEX_BLOCK, SLOTS = 1024, 10, 64, 8192, 1024
INDEX = "block bigint, n bigint, ids binary, lows binary, slices binary"
SETS = "set bigint, n_queries bigint, query_ids binary, queries binary"
FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to a width."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.zeros((len(column), max(width, int(lengths.max(initial=0)))), np.int64)
    at = np.repeat(np.arange(len(column)), lengths)
    rows[at, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return rows


def packed_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, ids, values) for rows (id, integers) taken together up to `size`; numbers are `size` apart."""
    number = TaskContext.get().partitionId() << 33
    ids, rows, n = [], [], 0

    def taken() -> tuple[int, np.ndarray, np.ndarray]:
        width = max(part.shape[1] for part in rows)
        return number, np.concatenate(ids), np.concatenate([np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in rows])

    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, size - n)
            ids.append(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            rows.append(matrix(part.column(1), 0))
            start, n = start + part.num_rows, n + part.num_rows
            if n == size:
                yield taken()
                number, ids, rows, n = number + size, [], [], 0
    if n:
        yield taken()


def slices(raised: np.ndarray) -> np.ndarray:
    """Of rows of non-negative integers: for each attribute and bit, from the least significant, the rows that have it."""
    n, width = raised.shape
    bits = max(1, int(raised.max(initial=0)).bit_length())
    out = np.zeros((width, bits, 8 * -(-n // 64)), np.uint8)
    for bit in range(bits):
        packed = np.packbits(((raised >> bit) & 1).astype(np.uint8), axis=0, bitorder="little")
        out[:, bit, :packed.shape[0]] = packed.T
    return out.view(np.uint64)


def block_task(size: int) -> Callable:
    """Rows of the index; within a block rows are in the order of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, values in packed_rows(batches, size):
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], values[order]
            lows = values.min(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(ids)]), pa.array([ids.tobytes()]), pa.array([lows.tobytes()]),
                 pa.array([slices(values - lows).tobytes()], pa.binary())], ["block", "n", "ids", "lows", "slices"])

    return run


def set_task(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, values in packed_rows(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(ids)]), pa.array([ids.tobytes()]), pa.array([values.tobytes()])],
                ["set", "n_queries", "query_ids", "queries"])

    return run


def added(parts: list[np.ndarray]) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """The sum of bit maps of one significance: the map that stays there, and those carried to the next one."""
    carried: list[np.ndarray] = []
    here = np.concatenate(parts) if parts else None
    while here is not None and len(here) > 1:
        third = len(here) // 3
        if third:
            a, b, c, rest = here[:third], here[third:2 * third], here[2 * third:3 * third], here[3 * third:]
            half = a ^ b
            carried.append((a & b) | (c & half))
            here = np.concatenate((half ^ c, rest))
        else:
            carried.append(here[:1] & here[1:])
            here = here[:1] ^ here[1:]
    return None if here is None or not len(here) else here[0], carried


class Block:
    """One row of the index."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.lows = np.frombuffer(row["lows"], np.int64)
        words = -(-row["n"] // 64)
        packed = np.frombuffer(row["slices"], np.uint64)
        bits = len(packed) // (words * len(self.lows)) if len(self.lows) else 0
        self.slices = packed.reshape(len(self.lows), bits, words)
        self.rows = self.map_of(np.arange(row["n"]))

    def map_of(self, places: np.ndarray) -> np.ndarray:
        flags = np.zeros(64 * -(-len(self.ids) // 64), np.uint8)
        flags[places] = 1
        return np.packbits(flags, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the scores from the least significant, and what is to be added to what they say."""
        query = query[:len(self.lows)]
        lows, bits = self.lows[:len(query)], self.slices.shape[1]
        negative = query < 0
        size = np.abs(query)
        signed = self.slices[:len(query)] ^ np.where(negative, ~np.uint64(0), np.uint64(0))[:, None, None]
        query_bits = int(size.max(initial=0)).bit_length()
        having = [np.flatnonzero((size >> bit) & 1) for bit in range(query_bits)]
        out, carried, weight = [], [], 0
        while weight < bits + query_bits - 1 or carried:
            parts = [signed[having[bit], weight - bit] for bit in range(query_bits)
                     if 0 <= weight - bit < bits and len(having[bit])]
            here, carried = added(parts + carried)
            out.append(np.zeros_like(self.rows) if here is None else here)
            weight += 1
        return out, int(lows @ query) - ((1 << bits) - 1) * int(size[negative].sum())

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows of other ids."""
        score, more = self.scores(query)
        own = slice(*np.searchsorted(self.ids, [query_id, query_id + 1]))
        certain = np.zeros_like(self.rows)
        boundary = self.rows & ~self.map_of(np.arange(own.start, own.stop))
        n = 0
        for part in reversed(score):
            upper = boundary & part
            among = int(np.bitwise_count(upper).sum())
            if n + among > k:
                boundary = upper
            else:
                certain, boundary, n = certain | upper, boundary & ~part, n + among
                if n == k:
                    break
        places = np.concatenate((self.places(certain), self.places(boundary)[:k - n]))
        found = np.zeros(len(places), np.uint64)
        for weight, part in enumerate(score[:64]):
            found |= ((part[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)) << np.uint64(weight)
        return self.ids[places], found.view(np.int64) + np.int64(more)

    @staticmethod
    def places(rows: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))


def best_per_query(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each query, ties to smaller ids."""
    order = np.lexsort((ids, -score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query, "left")
    return order[np.arange(len(order)) - first < k]


def search_task(k: int) -> Callable:
    """Rows of a set beside a block; the best of blocks that follow each other with the same set are kept together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        number, query_ids, held = None, none, (none, none, none)

        def best() -> pa.RecordBatch:
            query, ids, score = held
            return pa.RecordBatch.from_arrays(
                [pa.array(number + query), pa.array(query_ids[query]), pa.array(ids), pa.array(score)],
                ["query", "query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["set"] != number:
                    if len(held[0]):
                        yield best()
                    number, held = row["set"], (none, none, none)
                    query_ids = np.frombuffer(row["query_ids"], np.int64)
                    queries = np.frombuffer(row["queries"], np.int64).reshape(len(query_ids), -1)
                block, parts = Block(row), [held]
                for query, values in enumerate(queries):
                    ids, score = block.best(int(query_ids[query]), values, k)
                    parts.append((np.full(len(ids), query), ids, score))
                query, ids, score = (np.concatenate(column) for column in zip(*parts, strict=True))
                kept = best_per_query(query, ids, score, k)
                held = (query[kept], ids[kept], score[kept])
        if len(held[0]):
            yield best()

    return run


def build_index(
    vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE,
    block: int = INDEX_BLOCK,
) -> DataFrame:
    """The bit-sliced index of all usable rows, one row per block: write it to use it again."""
    vector = F.col(vector_column)
    rows = vectors.where(usable(vector) & F.col(id_column).isNotNull())
    return rows.select(F.col(id_column).cast("bigint"), quantised(vector, scale)).mapInArrow(block_task(block), INDEX)


def search(
    index: DataFrame, queries: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE, k: int = K, query_set: int = QUERY_SET,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries the k highest integer inner products with rows of a
    stored index, but those of the query's id. The index must be a table: it is read twice."""
    vector = F.col(vector_column)
    asked = queries.where(usable(vector) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("vec_id"), quantised(vector, scale).alias("q")).distinct()
    sets = shared(asked.mapInArrow(set_task(query_set), SETS))
    slots = max(1, min(SLOTS, index.count()))
    # Few bytes, but much work: dealt to a number of tasks, not merged into few.
    pairs = sets.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).join(
        index.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).repartition(slots, "slot"), "slot")
    found = pairs.mapInArrow(search_task(k), FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame, is_query: Column, *, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE, k: int = K, block: int = INDEX_BLOCK, query_set: int = QUERY_SET,
) -> DataFrame:
    """The same for the rows of a table that are queries, against all its rows."""
    named = {"id_column": id_column, "vector_column": vector_column, "scale": scale}
    index = shared(build_index(vectors, block=block, **named))
    return search(index, vectors.where(is_query), k=k, query_set=query_set, **named)

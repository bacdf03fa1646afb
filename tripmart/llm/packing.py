"""Sum-of-squares packing of token sequences.

Texts are tokenised once and stored as pieces; only lengths are packed. A piece of the whole capacity is a sequence of
its own. All others are dealt by hash to groups of bounded size, and each group is packed in one task: pieces come
from the longest down, and each goes where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest. A new sequence is opened only where no open one has room. Pieces of sequences that a group leaves
with a gap go to the next round, until one group holds all that is left, so sequences lost to grouping do not add up
with the table. A round that leaves over half of its pieces so is the last one: such lengths gain nothing from being
dealt again. Sequence ids name round, group and place, so reruns agree.

Defined results: null and empty texts are the closing id alone. Repeated rows and ids are pieces of their own. Texts of
any length are cut into whole pieces, the first one shorter. An empty table gives no pieces. Only the two columns named
are read, so other columns, whatever their names, play no part. Texts of equal length are told apart by row order.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import shared, stored

CAPACITY, CLOSING_ID = 2048, 0
# Pieces that one task packs.
GROUP_PIECES = 1 << 15
# Tokens that a task hands on together.
TOGETHER_TOKENS = 1 << 20

# The split pattern of this kind of vocabulary, and the last character whose classes all Unicode versions share.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BEYOND_SHARED = re.compile("[^\u0000-ԯ]")


def byte_of_letter() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(byte): byte for byte in prints}
    for at, byte in enumerate(sorted(set(range(256)) - set(prints))):
        letters[chr(256 + at)] = byte
    return letters


class Encoder:
    """Ids of a text by a byte-level BPE file of the tokenizers library.

    Texts of Latin, Greek and Cyrillic letters take a faster path over the same vocabulary and give the same ids; all
    others, and those that hold a special token, go through the tokenizers library.
    """

    def __init__(self, definition: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_str(definition)
        parsed, letters = json.loads(definition), byte_of_letter()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in parsed["model"]["vocab"].items()}
        self._fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._special = [token["content"] for token in parsed["added_tokens"]]

    def ids(self, text: str) -> np.ndarray:
        if BEYOND_SHARED.search(text) or any(token in text for token in self._special):
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._fast.encode_to_numpy(text, disallowed_special=())


@cache
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


def piece_task(definition: str, capacity: int, closing: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, key = encoder(definition).ids, TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, parts, held = [], [], 0
            for row, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(closing)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                for piece, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(row)
                    parts.append((key, piece, start, end - start, ids[start:end].tobytes()))
                    key += 1
                held += len(ids)
                if held > TOGETHER_TOKENS or row == batch.num_rows - 1:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*parts, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns],
                                                     ["row", "key", "piece", "start", "length", "ids"])
                    rows, parts, held = [], [], 0

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lengths from 1 to capacity - 1, in the order they are placed: sequence, offset, and the gap the sequence ends with."""
    open_with = np.zeros(capacity + 1, np.int64)  # by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    gaps: list[int] = []
    unfit = np.iinfo(np.int64).max
    for at, length in enumerate(lengths.tolist()):
        from_gap, to_gap = open_with[length:], open_with[:capacity + 1 - length]
        # Taking one of a and making it one of b changes a^2 + b^2 by 2 (b - a + 1); a gap of 0 is no open sequence.
        change = 2 * (to_gap - from_gap + 1)
        change[0] = 1 - 2 * from_gap[0]
        change[from_gap == 0] = unfit
        left = int(change.argmin())
        if change[left] == unfit:
            left, place = capacity - length, len(gaps)
            gaps.append(capacity)
        else:
            place = waiting[length + left].pop()
            open_with[length + left] -= 1
        sequence[at], offset[at], gaps[place] = place, capacity - gaps[place], left
        if left:
            open_with[left] += 1
            waiting[left].append(place)
    return sequence, offset, np.array(gaps, np.int64)[sequence]


def group_task(capacity: int) -> Callable:
    """(key, length, group, sequence, place, full)."""
    def run(table: pa.Table) -> pa.Table:
        keys, lengths = table.column("key").to_numpy(), table.column("length").to_numpy()
        order = np.lexsort((keys, -lengths))
        sequence, place, gap = sum_of_squares(lengths[order], capacity)
        return pa.table({"key": keys[order], "length": lengths[order], "group": table.column("group"),
                         "sequence": sequence, "place": place, "full": gap == 0})

    return run


def placed(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(key, sequence_id, offset) of pieces (key, length) shorter than the capacity."""
    done, number = [], 0
    left = pieces.where(F.col("length") < capacity).select("key", "length")
    n_left = left.count()
    while True:
        groups = max(1, -(-n_left // group_pieces))
        dealt = left.withColumn("group", F.pmod(F.xxhash64("key", F.lit(number)), F.lit(groups)))
        packed = shared(dealt.groupBy("group").applyInArrow(
            group_task(capacity), "key bigint, length bigint, group bigint, sequence bigint, place bigint, full boolean"))
        # 8 bits of rounds, 31 of groups, 24 of sequences.
        name = (F.lit(number << 55) + F.col("group") * (1 << 24) + F.col("sequence")).alias("sequence_id")
        before, left = n_left, packed.where("NOT full").select("key", "length")
        n_left = left.count()
        last = groups == 1 or 2 * n_left > before
        done.append((packed if last else packed.where("full")).select("key", name, F.col("place").alias("offset")))
        if last:
            break
        number += 1
    together = done[0]
    for more in done[1:]:
        together = together.unionByName(more)
    return together


def pack(
    docs: DataFrame, tokenizer_path: str, *, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY, closing_id: int = CLOSING_ID, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: row (the document's id), piece, start, length, ids (little-endian 32-bit), sequence_id, offset.

    The driver reads the tokenizer file (of a fixed size) and hands it to the tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    texts = docs.select(F.col(id_column).alias("row"), F.col(text_column).alias("text"))
    kind = texts.schema["row"].dataType.simpleString()
    pieces = stored(texts.mapInArrow(
        piece_task(definition, capacity, closing_id),
        f"row {kind}, key bigint, piece int, start bigint, length bigint, ids binary"), f"pieces-{uuid.uuid4().hex}")
    columns = ["row", "piece", "start", "length", "ids", "sequence_id", "offset"]
    whole = pieces.where(F.col("length") == capacity)
    whole = whole.withColumns({"sequence_id": -1 - F.col("key"), "offset": F.lit(0).cast("bigint")})
    short = pieces.where(F.col("length") < capacity).join(placed(pieces, capacity, group_pieces), "key")
    return whole.select(*columns).unionByName(short.select(*columns))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, rows): the ids of each sequence, one after the other, and the documents they come from."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "row"))).alias("parts")
    gathered = packed.groupBy("sequence_id").agg(parts)
    ids = F.aggregate("parts", F.lit(b""), lambda so_far, part: F.concat(so_far, part["ids"]))
    return gathered.select("sequence_id", ids.alias("ids"), F.col("parts.row").alias("rows"))

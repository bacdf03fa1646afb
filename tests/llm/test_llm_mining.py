"""Collocations, packing and hard negatives against plain Python, with awkward rows and small limits."""

import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

from tripmart.llm import collocations, hard_negatives, packing  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
CLASHING = {"key": 1, "row": "x", "bucket": 2, "group": 3, "n": 4, "words": "w", "sequence_id": 5, "set": 6, "slot": 7, "block": 8, "id": 9}


def with_clashing(frame):
    return frame.withColumns({name: F.lit(value) for name, value in CLASHING.items() if name not in frame.columns})


# Collocations


def phrases(frame, **options):
    return sorted(tuple(row) for row in collocations.collocations(frame, **options).collect())


AWKWARD_TEXTS = [
    ("en", "New York, new york; NEW\tYORK new york"), ("en", "new york city new york city new york city"), ("en", None),
    (None, "a b a b a b a b"), ("und", "a b a b"), ("de", ""), ("de", " .,; \n"), ("fr", "été là été là été là"),
    ("a\tb", "x y x y x y x y"), ("en", "new york " * 3_000), ("en", "new york city new york city new york city"),
    ("en", "same same same same same same same same same same same same"), ("fr", "\x00 \x00 \x00   \x00  "),
]


@pytest.mark.parametrize("options", [{}, {"bucket_words": 7}, {"bucket_words": 7, "hot": 3}, {"hot": 1}])
def test_phrases_match_plain_python(spark, monkeypatch, options):
    monkeypatch.setattr(collocations, "isqrt", lambda words: 0)
    frame = spark.createDataFrame(AWKWARD_TEXTS * 2, "lang string, text string").repartition(3)
    expected = plain.collocations(AWKWARD_TEXTS * 2, min_count=3, top=5)
    assert phrases(with_clashing(frame), min_count=3, top=5, **options) == sorted(expected)
    assert {row[0] for row in expected} == {"en", "und", "fr", "a\tb"}


def test_phrases_of_many_batches(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text")
    monkeypatch.setattr(collocations, "TOGETHER", 10_000)
    found = phrases(docs.repartition(5), bucket_words=5_000, hot=200)
    assert found == sorted(plain.collocations([tuple(row) for row in docs.collect()])) and len(found) > 100


def test_a_pair_is_dropped_only_for_extensions_that_are_candidates(spark):
    texts = [("x", "p q r.")] * 9 + [("x", "p q.")] * 9 + [("y", "p q r.")] * 10 + [("y", "p q.")] * 10 + [("z", "r p q.")] * 10
    found = phrases(spark.createDataFrame(texts, "lang string, text string"))
    assert [(row[0], row[2]) for row in found] == [("x", "p q"), ("y", "p q r"), ("z", "r p q")]
    assert found == sorted(plain.collocations(texts))


def test_scores_are_exact_beyond_64_bits(spark):
    large = 3 * 10**14 + 7
    row = spark.range(1).select(collocations.ratio(F.lit(large), F.lit(large + 1), F.lit(large + 2)).alias("score")).first()
    assert row["score"] == 10**6 * large * large // ((large + 1) * (large + 2))


def test_no_phrases_without_documents(spark):
    assert phrases(spark.createDataFrame([], "lang string, text string")) == []
    assert phrases(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")) == []


# Packing


def packed_rows(spark, texts, **options):
    docs = with_clashing(spark.createDataFrame(texts, "doc_id bigint, text string"))
    return packing.pack(docs, VOCABULARY, **options)


def expected_pieces(texts, capacity):
    tokenizer, out = Tokenizer.from_file(VOCABULARY), []
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
        out += [(doc, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


TEXTS = [
    (1, None), (2, ""), (3, "one"), (3, "one"), (None, "no id at all"), (4, "word " * 70), (5, "word " * 69), (6, "many words " * 5_000),
    (7, "a" * 300_000), (8, "中文 text, кириллица ꟁ and \u0085   blanks"), (9, "before <|endoftext|> after"), (10, "x  \n\n y\t z"),
]


@pytest.mark.parametrize("options", [{}, {"capacity": 70}, {"capacity": 70, "group_pieces": 3}, {"capacity": 1}])
def test_pieces_are_whole_and_gapless(spark, options):
    capacity = options.get("capacity", packing.CAPACITY)
    texts = [(doc, text) for doc, text in TEXTS if capacity > 1 or doc not in (6, 7)]
    packed = packed_rows(spark, texts, **options)
    rows = packed.collect()
    key = repr
    assert sorted(((r["row"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows), key=key) == sorted(
        expected_pieces(texts, capacity), key=key)
    ends = {}
    for row in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == ends.get(row["sequence_id"], 0)
        ends[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(ends.values()) <= capacity
    whole = {r["sequence_id"]: (len(r["ids"]) // 4, len(r["rows"])) for r in packing.sequences(packed).collect()}
    assert {name: size for name, (size, _) in whole.items()} == ends
    assert sum(n for _, n in whole.values()) == len(rows)


def test_every_character_of_the_fast_path_gives_the_same_ids():
    with open(VOCABULARY, encoding="utf-8") as file:
        encode = packing.encoder(file.read()).ids
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for code in range(0x560):
        c = chr(code)
        text = f"a{c} {c}b{c}{c}1 {c}'s  {c}\n{c}"
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, hex(code)


def test_sequences_are_about_as_few_as_can_be(spark):
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.lognormal(6.3, 0.9, 12_000).astype(np.int64) + 1, 2047)
    frame = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "key bigint, length bigint")
    least = -(-int(lengths.sum()) // 2048)
    for group_pieces in (20_000, 2_000):
        first = packing.placed(frame, group_pieces=group_pieces).toPandas()
        assert len(first) == len(lengths) and first["sequence_id"].nunique() <= least * 1.003 + 2
        again = packing.placed(frame.repartition(7), group_pieces=group_pieces).toPandas()
        assert first.sort_values("key").reset_index(drop=True).equals(again.sort_values("key").reset_index(drop=True))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=60))
def test_places_minimise_the_sum_of_squares(lengths):
    sequence, offset, _ = packing.sum_of_squares(np.array(lengths, np.int64), 20)
    gaps = []
    for length, place, at in zip(lengths, sequence.tolist(), offset.tolist(), strict=True):
        fitting = [k for k, gap in enumerate(gaps) if gap >= length]

        def squares(k, length=length):
            after = [*gaps[:k], gaps[k] - length, *gaps[k + 1:]]
            return sum(after.count(gap) ** 2 for gap in set(after) if gap)

        if fitting:
            assert place in fitting and squares(place) == min(map(squares, fitting))
        else:
            assert place == len(gaps)
            gaps.append(20)
        assert at == 20 - gaps[place]
        gaps[place] -= length


def test_no_pieces_without_documents(spark):
    assert packed_rows(spark, []).collect() == []


def test_checksums_are_of_little_endian_ids(spark):
    rows = packed_rows(spark, [(1, "some words here")]).select("ids", F.crc32("ids").alias("crc")).first()
    assert rows["crc"] == zlib.crc32(bytes(rows["ids"]))


# Hard negatives


def mined(frame, **options):
    return sorted(tuple(row) for row in hard_negatives.hard_negatives(frame, F.col("vec_id") % 5 == 0, **options).collect())


def expected_negatives(rows, scale=256, n_positives=5, n_negatives=3, low=50, high=95):
    def sound(row):
        return None not in row and all(x is not None and np.isfinite(x) for x in row[1])

    rows = [(k, i, [int(np.floor(scale * float(x))) for x in v], label) for k, (i, v, label) in enumerate(filter(sound, rows))]
    out = []
    for key, anchor, q, label in rows:
        if anchor % 5:
            continue
        scores = [(sum(a * b for a, b in zip(q, other, strict=False)), i, of, k) for k, i, other, of in rows if k != key]
        same = sorted((-s, i) for s, i, of, _ in scores if of == label)[:n_positives]
        for score, positive in same:
            fit = sorted((-s, i) for s, i, of, _ in scores if of != label and -low * score <= 100 * s <= -high * score)
            out += [(anchor, positive, rank, i, -score, -s) for rank, (s, i) in enumerate(fit[:n_negatives], 1)]
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<double>, label int"


def random_vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=width)
    return [(k, [float(x) for x in centre + spread * rng.normal(size=width)], int(rng.integers(3))) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"block": 7, "anchors_per_set": 3}])
def test_negatives_match_plain_python(spark, options):
    rows = random_vectors(120, 9, 1)
    rows += [(k, rows[0][1], 1) for k in (200, 201, 205, 205, 205)] + [(300, rows[1][1], 2), (301, [0.0] * 9, 0)]
    rows += [(400, None, 1), (401, [1.0, None], 1), (405, [float("nan")] * 9, 1), (410, [float("inf")] * 9, 1), (None, [1.0] * 9, 1),
             (415, [1.0] * 9, None), (420, [1.0, 2.0], 1), (425, [], 2)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(4)
    found = mined(with_clashing(frame).drop("id").withColumn("id", F.lit(1)), **options)
    assert found == expected_negatives(rows) and len(found) > 100


def test_large_components_and_long_vectors_stay_exact(spark):
    rows = random_vectors(40, 150, 2, spread=0.3)
    for scale in (1, 256, 2_000_000):
        assert mined(spark.createDataFrame(rows, VECTORS), scale=scale) == expected_negatives(rows, scale)
    with pytest.raises(ValueError, match="do not fit"):
        mined(spark.createDataFrame(rows, VECTORS), scale=1 << 34)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**30), st.integers(1, 200), st.integers(0, 24))
def test_residues_give_exact_products(seed, width, bits):
    rng = np.random.default_rng(seed)
    left, right = (rng.integers(-(1 << bits), (1 << bits) + 1, (n, width)) for n in (3, 4))
    primes = hard_negatives.moduli(width << 2 * bits)
    assert (hard_negatives.exact_products(left, right, primes) == left @ right.T).all()


def test_products_reach_the_whole_range():
    for value in (1, 510, 511, 512, 1 << 27):
        row = np.full((1, 64), value)
        primes = hard_negatives.moduli(64 * value * value)
        assert hard_negatives.exact_products(row, -row, primes)[0, 0] == -64 * value * value


def test_no_negatives_without_anchors(spark):
    assert mined(spark.createDataFrame([], VECTORS)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], VECTORS)) == []
    assert mined(spark.createDataFrame([(5, [1.0], 1)], VECTORS)) == []

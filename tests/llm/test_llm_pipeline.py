"""Every stage of the pipeline on awkward rows: nulls in any column, empty and long texts, repeated rows, columns of
clashing names, and empty tables."""

import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from tripmart.llm.queries import llm_queries  # noqa: E402

PROSE = "the quick fox saw a dog near the river and then it went home to sleep for a while under some old trees"
OTHER = " ".join(f"other{k}" for k in range(60))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels and benchmark items with nulls and repeated rows."""
    path = tmp_path_factory.mktemp("tables")
    labels = [(k, k % 2, 0) for k in range(40)] + [(None, 1, None), (3, None, 0), (3, 1, 0), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (None, None), (2, "")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def awkward(spark):
    texts = [(k, f"{PROSE} {k}" if k % 2 else "AA!! BB!! $$$ ###") for k in range(40)]
    texts += [(100, None), (101, ""), (None, f"{PROSE} with no id"), (None, None), (102, PROSE + " tail " * 20_000),
              (103, "a line\nanother\nthird\nown 1"), (104, "a line\nanother\nthird\nown 2"), (105, OTHER), (105, OTHER),
              (106, "Say W1 w2, w3 w4 w5 w6 w7 w8 w9 w10 done")]
    docs = plain.documents(spark, texts, ["s", None])
    for name in ("key_", "score_", "row", "size", "rate", "fingerprint", "label_", "target"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.mark.parametrize("position", range(5))
def test_stage_on_awkward_and_on_no_rows(spark, folder, position):
    name, stage = corpus_pipeline.STAGES[position]
    docs = awkward(spark)
    kept = stage(spark, docs, folder)
    rows = kept.collect()
    last = position == len(corpus_pipeline.STAGES) - 1
    assert tuple(kept.columns)[:5] == corpus_pipeline.COLUMNS and (last or len(kept.columns) == 5)
    assert 0 < len(rows) <= (3 if last else 1) * docs.count()
    ids = [r["doc_id"] for r in rows]
    if name == "lines":
        assert len(rows) == docs.count()
        assert {r["text"] for r in rows if r["doc_id"] in (103, 104)} == {"a line\nanother\nthird\nown 1", "own 2"}
        assert {r["n_chars"] for r in rows if r["doc_id"] == 104} == {5}
    if name == "near_copies":
        assert ids.count(105) == 1 and ids.count(100) == 1 and 101 not in ids
    if name == "benchmark_free":
        assert len(rows) == docs.count() - 1 and 106 not in ids
    if last:
        planned = corpus_pipeline.plan(docs).collect()
        assert len(planned) == docs.count() and [r["doc_id"] for r in planned].count(105) == 2
        assert all(r["taken"] <= 3 * r["size"] for r in planned)
        assert Counter(ids) == sum((Counter({r["doc_id"]: r["copies"]}) for r in planned if r["copies"]), Counter())
    assert stage(spark, docs.limit(0), folder).collect() == []


def test_run_over_awkward_rows_and_over_none(spark, folder, tmp_path):
    for name, docs in (("some", awkward(spark)), ("none", awkward(spark).limit(0))):
        place = tmp_path / name
        docs.write.parquet(f"{place}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{folder}/{table}.parquet").write.parquet(f"{place}/{table}.parquet")
        rows = corpus_pipeline.run(spark, str(place)).collect()
        assert bool(rows) == (name == "some")
        assert 106 not in [r["doc_id"] for r in rows]


def test_corpus_holds_what_the_mix_takes(spark, folder, tmp_path):
    picks = random.Random(12)
    texts = ["".join(picks.choice("abcdefgh") + " " for _ in range(picks.randint(1, 60))) for _ in range(400)] + [None, ""]
    docs = plain.documents(spark, texts, ["a", "b", "b", "b", "b", None])
    copies = {r["doc_id"]: r["copies"] for r in corpus_pipeline.plan(docs).collect()}
    rows = corpus_pipeline.mixture(spark, docs, folder).collect()
    assert 0 in copies.values() and max(copies.values()) > 1
    assert Counter(r["doc_id"] for r in rows) == Counter({doc: n for doc, n in copies.items() if n})
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)
    words, target = Counter(), {}
    for r in rows:
        words[r["source"]] += len((r["text"] or "").split())
        target[r["source"]] = r["target"]
    assert set(target) == {"a", "b", None}
    assert all(abs(words[source] - target[source]) <= 1 for source in target)


def test_pipeline_query_returns_the_mixed_corpus(spark):
    small = "/root/testdata/sf0.001"
    rows = llm_queries()["pipeline"](spark, small).collect()
    assert sorted(rows, key=str) == sorted(corpus_pipeline.run(spark, small).collect(), key=str)
    assert any(r["copies"] > 1 for r in rows) and all(1 <= r["copy"] <= r["copies"] for r in rows)
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows)
    for source, target in {(r["source"], r["target"]) for r in rows}:
        sizes = [r["size"] for r in rows if r["source"] == source]
        assert abs(sum(sizes) - target) <= max(sizes)

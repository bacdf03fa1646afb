"""The registered queries over whole sample tables: against SQL, or plain Python where SQL cannot express them."""

import hashlib
import os
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from tripmart.llm import lm_score  # noqa: E402
from tripmart.llm.oracle import llm_oracles  # noqa: E402
from tripmart.llm.queries import llm_queries, quality_model  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(frame.where(frame.notna(), None).itertuples(index=False, name=None), key=repr)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, duck, name):
    actual, expected = llm_queries()[name](spark, SF_DIR).toPandas(), duck.execute(llm_oracles()[name]).df()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert rows(actual) == rows(expected)
    assert len(actual)


def test_every_number_has_a_query():
    names = list(llm_queries())
    assert [name.split("_")[0] for name in names] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


def texts(spark, sf_dir=SF_DIR):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def test_quality_on_held_out_labels(spark):
    found = llm_queries()["op3_quality"](spark, SF_DIR).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().set_index("doc_id")
    held = found[found.held_out].join(labels, how="inner")
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_quality_like_plain_python(spark):
    """Every statistic, every score from the fitted rules, and the rows that no label is learned from."""
    model, stats = quality_model(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    assert model.rules
    own = {doc: plain.statistics(text) for doc, text in texts(spark).items()}
    measured = {r["doc_id"]: r for r in stats.collect()}
    assert set(measured) == set(own)
    for doc, expected in own.items():
        assert {name: measured[doc][name] for name in expected} == pytest.approx(expected, rel=1e-12)
    for row in llm_queries()["op3_quality"](spark, SF_DIR).collect():
        score = plain.rule_score(model.intercept, model.rules, own[row["doc_id"]])
        assert row["score"] == pytest.approx(score, abs=1e-6)
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.3)


def test_language_model_backs_off(spark, duck, tmp_path, monkeypatch):
    """Scores of whole tables, with nulls and copies, come from the other rows, so that back-off decides some of them."""
    own = [*list(texts(spark, SMALL).values())[:60], None, "", "own words of one row", "in two rows alike", "in two rows alike"]
    own = [(None if k % 9 == 0 else k % 50, text) for k, text in enumerate(own)]
    plain.documents(spark, own).write.parquet(f"{tmp_path}/documents.parquet")
    found = llm_queries()["op10_lm_score"](spark, str(tmp_path)).toPandas()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert rows(found) == rows(connection.execute(llm_oracles()["op10_lm_score"]).df())
    wanted = plain.log_scores_by_others([text for _, text in own])
    by_scores = lambda some: sorted(some, key=repr)
    got = by_scores((int(n), None if not n else round(s, 4)) for n, s in zip(found.n_words, found.mean_log_score, strict=True))
    assert got == by_scores((n, None if not n else round(s / n, 4)) for n, s in wanted)
    monkeypatch.setattr(lm_score.language_model_scores, "__kwdefaults__", lm_score.language_model_scores.__kwdefaults__ | {"backoff": 0.2})
    other = llm_queries()["op10_lm_score"](spark, str(tmp_path)).toPandas()
    assert rows(other) != rows(found)


def test_suffix_dedup_like_plain_python(spark):
    found = {r["doc_id"]: r for r in llm_queries()["op6_suffix_dedup"](spark, SF_DIR).collect()}
    own = texts(spark)
    for doc, (size, runs, kept) in zip(own, plain.repeated_bytes(own.values(), 400), strict=True):
        got = found[doc]
        assert (got["n_bytes"], got["n_removed"], got["n_spans"]) == (size, size - len(kept), runs)
        assert got["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_simhash_like_plain_python(spark):
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in llm_queries()["op7_simhash"](spark, SF_DIR).collect()}
    prints = {doc: plain.fingerprint(text) for doc, text in texts(spark).items()}
    wanted = plain.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert found == {doc: (f"{value:016x}", wanted[doc]) for doc, value in prints.items()}


def test_mix_of_all_documents(spark):
    found = llm_queries()["op8_mixing"](spark, SF_DIR).toPandas()
    sizes = {doc: len((text or "").encode().split()) for doc, text in texts(spark).items()}
    assert dict(zip(found.doc_id, found["size"], strict=True)) == sizes
    total = found.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((total.taken - total.target).abs() <= 0.01 * total.target).all()
    assert total.target.sum() == pytest.approx(found["size"].sum())


def test_pipeline_like_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, stages = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SMALL)
        stages[name] = {r["doc_id"]: r for r in kept.collect()}
        kept = spark.createDataFrame(list(stages[name].values()), kept.schema)
    good = stages["quality"]
    assert 0 < len(good) < docs.count()
    deduped = plain.lines_kept([(doc, r["text"]) for doc, r in good.items()])
    assert {doc: r["text"] for doc, r in stages["lines"].items()} == deduped
    prints = {doc: plain.fingerprint(text) for doc, text in deduped.items()}
    groups = plain.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    one = {doc: text for doc, text in deduped.items() if groups[doc] == doc}
    assert {doc: r["text"] for doc, r in stages["near_copies"].items()} == one
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {doc for doc, _, n_hit, _ in plain.contaminated(list(one.items()), bench) if not n_hit}
    assert set(stages["benchmark_free"]) == clean
    left = spark.createDataFrame(list(stages["benchmark_free"].values()), docs.schema)
    planned = {r["doc_id"]: r for r in corpus_pipeline.plan(left).collect()}
    assert set(planned) == clean
    taken = Counter({doc: r["copies"] for doc, r in planned.items() if r["copies"]})
    again = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(r["doc_id"] for r in again) == taken and set(stages["mixture"]) == set(taken)
    assert all(r["text"] == one[r["doc_id"]] and r["target"] == planned[r["doc_id"]]["target"] for r in again)
    assert {(r["doc_id"], r["copy"]) for r in again} == {(doc, k + 1) for doc, n in taken.items() for k in range(n)}


def test_mixture_like_plain_python(spark):
    found = llm_queries()["op8_mixing"](spark, SF_DIR).collect()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()
    size = {d["doc_id"]: len(re.findall("[^\x20\x09-\x0d]+", d["text"] or "")) for d in documents}
    source = {d["doc_id"]: d["source"] for d in documents}
    assert {r["doc_id"]: r["size"] for r in found} == size and len(found) == len(documents)
    whole, taken = Counter(), Counter()
    for doc, words in size.items():
        whole[source[doc]] += words
    targets = plain.mixing_targets(whole)
    for row in found:
        name = source[row["doc_id"]]
        assert row["source_size"] == whole[name] and row["target"] == pytest.approx(targets[name], rel=1e-9)
        assert row["taken"] % max(1, row["size"]) == 0 and row["taken"] <= 3 * row["size"]
        taken[name] += row["taken"]
    for name, target in targets.items():
        assert taken[name] == pytest.approx(target, abs=max(d for k, d in size.items() if source[k] == name))

"""Each operator against plain Python on small tables with nulls, empty and long texts, ties, repeated rows, empty
tables and columns of clashing names."""

import math
import random
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

from tripmart.llm import (  # noqa: E402
    decontaminate, fixity, line_dedup, lm_score, mixing, quality_rules, simhash, suffix_dedup, topk, url_filter,
)
from tripmart.llm.common import shared  # noqa: E402
from tripmart.llm.components import smallest_reachable  # noqa: E402

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]


# URL filter

def urls(spark, values, rules=RULES, **more):
    pages = spark.createDataFrame(list(enumerate(values)), "page_id bigint, url string").withColumn("rule", F.lit("x"))
    found = url_filter.filter_urls(pages, spark.createDataFrame(rules, "rule string, verdict string"), **more)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}


def test_urls_of_every_shape(spark):
    long = "http://" + "a." * 3000 + "example.com/en/" + "x" * 100_000
    got = urls(spark, [
        "https://WWW.Example.com/en/1?x=http://b", "http://m.example.com/en/", "http://example.com/EN/", None, "",
        "no scheme.com/", "http://example.com", "http://notexample.com/en/", "x://a.NET/es/?q#f", "http://É.net/es/1",
        long, "http://example.com/en/", "http://example.com/en/", "http://example.com:80/en/",
    ])
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1][2:] == ("example.com/en/", "block")
    assert got[2][2:] == ("com/", "allow")
    assert got[3] == got[4] == got[5] == ("", "", None, "allow")
    assert got[6] == ("example.com", "", None, "allow")
    assert got[7][2:] == ("com/", "allow")
    assert got[8] == ("a.net", "/es/", "net/es/", "block")
    assert got[9][0] == "É.net" and got[9][3] == "block"
    assert got[10][2:] == ("example.com/en/", "block")
    assert got[11] == got[12] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[13][2:] == (None, "allow")


def test_urls_without_rules_and_without_pages(spark):
    assert urls(spark, ["http://a.com/"], rules=[(None, None), (" ", "block")]) == {0: ("a.com", "/", None, "allow")}
    assert urls(spark, []) == {}


def test_block_wins_among_contradicting_rules_and_columns_are_kept(spark):
    got = urls(spark, ["http://a.com/x"], rules=[("a.com", "allow"), ("a.com", "block")])
    assert got[0] == ("a.com", "/x", "a.com", "block")
    pages = spark.createDataFrame([(1, "http://a.com/", "mine")], "page_id bigint, url string, verdict string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    assert url_filter.filter_urls(pages, rules, keep=("verdict",)).collect()[0][-1] == "mine"


# Line dedup

def test_lines_like_plain_python(spark):
    picks = random.Random(1)
    texts = ["\n".join(picks.choice("abc") for _ in range(picks.randint(0, 9))) for _ in range(60)]
    texts += [None, "", "\n\n\n\n", "a\nb\nc", "a\nb\nc\n", "\n".join(f"line {k % 700}" for k in range(5000))]
    docs = plain.documents(spark, texts).withColumn("covered", F.lit(1))
    got = line_dedup.remove_repeated_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert {r["doc_id"]: r["text"] for r in got.collect()} == plain.lines_kept(list(enumerate(texts)))


def test_repeated_rows_and_null_ids_of_lines(spark):
    text = "x\ny\nz\nw"
    docs = plain.documents(spark, [(5, text), (5, text), (None, "q\nx\ny\nz"), (7, "x\ny\nz")])
    got = sorted(((r["doc_id"] or -1), r["text"], r["n_removed"]) for r in line_dedup.remove_repeated_lines(docs).collect())
    assert got == [(-1, "q\nx\ny\nz", 0), (5, "w", 3), (5, "w", 3), (7, "", 3)]
    assert line_dedup.remove_repeated_lines(docs.limit(0)).collect() == []


def test_line_dedup_and_one_of_each_take_columns_of_any_name(spark):
    names = {name: F.lit(k) for k, name in enumerate(["__llm_key", "__LLM_lines", "__llm_doc", "__llm__of", "a.b", "starts", "h1", "key"])}
    docs = plain.documents(spark, ["1\n2\n3\n4", "0\n1\n2\n3", "1\n2\n3\n4"])
    odd = docs.withColumns(names)
    deduped, expected = line_dedup.remove_repeated_lines(odd), line_dedup.remove_repeated_lines(docs)
    assert deduped.columns == [*odd.columns, "n_lines", "n_removed"]
    assert sorted(deduped.select(*expected.columns).collect()) == sorted(expected.collect())
    assert [row[6] for row in deduped.select(*[f"`{name}`" for name in deduped.columns]).select("`__LLM_lines`").distinct().select(
        *["`__LLM_lines`"] * 7).collect()] == [1]
    kept = simhash.one_of_each(odd.drop("a.b"))
    assert kept.columns == odd.drop("a.b").columns and kept.count() == simhash.one_of_each(docs).count()


# Quality classifier

def test_printed_trees_become_tight_rules():
    printed = ("Tree 0 (weight 1.0):\n    If (feature 2 <= 0.5)\n     If (feature 2 <= 0.25)\n      Predict: 0.0\n"
               "     Else (feature 2 > 0.25)\n      Predict: 1.0\n    Else (feature 2 > 0.5)\n     Predict: 1.0\n")
    assert quality_rules.tree_rules(printed) == {
        (("capitals", "<=", 0.5),), (("capitals", "<=", 0.25),),
        (("capitals", "<=", 0.5), ("capitals", ">", 0.25)), (("capitals", ">", 0.5),),
    }


def test_statistics_are_finite_for_every_text(spark):
    docs = plain.documents(spark, [None, "", " \n ", "A!! B!!", "é " * 50_000, "x" * 100_000, "| " * 10, "\u0000$$$"])
    for row in quality_rules.with_statistics(docs, "doc_id").collect():
        assert all(np.isfinite(row[name]) for name in quality_rules.NAMES)


def test_rules_separate_what_one_condition_cannot(spark):
    picks = random.Random(3)
    rows = [(1.0 * k, *[picks.random() for _ in range(10)]) for k in range(2000)]
    names = ", ".join(f"{name} double" for name in quality_rules.NAMES)
    frame = spark.createDataFrame(rows, names).withColumn(
        "y", ((F.col("capitals") > 0.5) & (F.col("symbols") > 0.4)).cast("int"))
    model = quality_rules.fit_rules(frame, "y")
    score = model.score({name: F.col(name) for name in quality_rules.NAMES})
    right = frame.select(((score > 0.5).cast("int") == F.col("y")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.95
    assert 0 < len(model.rules) < 150


def test_labels_of_one_kind_or_none_give_a_constant(spark):
    empty = spark.createDataFrame([], ", ".join(f"{name} double" for name in quality_rules.NAMES) + ", y int")
    assert quality_rules.fit_rules(empty, "y").rules == ()
    assert spark.range(1).select(quality_rules.fit_rules(empty, "y").score({})).first()[0] == 0.5


# Benchmark decontamination

def hits(spark, docs, items, **more):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contamination(decontaminate.find_matches(frame, bench, **more)).collect()
    return sorted(((r["row"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=repr)


def test_windows_like_plain_python(spark):
    picks = random.Random(4)
    some = lambda n: " ".join(picks.choice(["a", "b", "Öl", "x9"]) for _ in range(n))
    items = [(1, some(14)), (2, some(10)), (3, "a b"), (4, ""), (5, None), (6, "..."), (7, some(12)), (None, some(11))]
    items += [(8, items[0][1]), (9, "never seen words here")]
    docs = [(k, some(picks.randint(0, 60))) for k in range(40)]
    docs += [(100, "x. " + items[0][1].upper().replace("Ö", "Ö") + " y"), (101, items[1][1].replace(" ", "--")),
             (102, None), (103, ""), (100, "again " + items[7][1]), (104, some(30_000)), (None, items[6][1])]
    assert hits(spark, docs, items) == sorted(plain.contaminated(docs, items), key=repr)


def test_no_items_and_no_documents(spark):
    assert hits(spark, [(1, "a b")], []) == [(1, 2, 0, [])]
    assert hits(spark, [], [(1, "a b")]) == []


def test_proximity_allows_words_between_and_any_order(spark):
    docs = [(1, "red the green blue"), (2, "blue green red"), (3, "red a b c green d blue"), (4, "red green")]
    got = {row[0]: row[2] > 0 for row in hits(spark, docs, [(1, "red green blue")], width=3, slop=1)}
    assert got == {1: True, 2: True, 3: False, 4: False}


@pytest.mark.parametrize("slop", [1, 2, 4])
def test_proximity_like_plain_python(spark, slop):
    picks = random.Random(slop)
    some = lambda n: " ".join(picks.choice(["a", "b", "c", "d", "e"]) for _ in range(n))
    items = [(1, "a b"), (2, "red red green"), (3, some(5)), (4, "a"), (5, some(3)), (6, "e e e"), (7, "")]
    docs = [(k, some(picks.randint(0, 25))) for k in range(30)] + [(100, "a b"), (101, "red green blue"), (102, "green red x red"),
            (103, None), (104, "b x x x x a"), (105, "a b " * 40), (106, "x red x red x green x red")]
    found = hits(spark, docs, items, width=4, slop=slop)
    assert found == sorted(plain.near(docs, items, 4, slop), key=repr)
    assert all(n_hit <= n_words for _, n_words, n_hit, _ in found)


# Fixity audit


def test_audit_goes_down_damaged_branches_only(spark, monkeypatch):
    rows = spark.createDataFrame([(k, f"u{k}", "x") for k in range(70_000)], "page_id bigint, url string, html string")
    other = rows.withColumn("html", F.when(F.col("page_id") == 12_345, "y").otherwise(F.col("html")))
    written = []
    monkeypatch.setattr(fixity, "shared", lambda frame: written.append(shared(frame)) or written[-1])
    found = fixity.audit(rows, other)
    assert [(r["id"], r["status"], r["primary_offset"]) for r in found.collect()] == [
        (12_345, "changed", sum(len(f"u{k}") + 1 for k in range(12_345)))]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and plan.index("FullOuter") < plan.index("LeftSemi")
    suspects = [frame.count() for frame in written if "left_before" in frame.columns]
    assert suspects == [1] * len(suspects) and len(suspects) >= 3
    written.clear()
    assert fixity.audit(rows, rows).collect() == []
    assert [frame.count() for frame in written if "left_before" in frame.columns] == [0]

def test_audit_finds_all_damage_and_its_offsets(spark):
    rows = [(k, f"u{k}", "x" * (k % 50)) for k in range(-70, 5000, 3)] + [(None, "n", None), (8, "again", "z"), (8, "again", "z")]
    other = [r for r in rows if r[0] != 500] + [(501, "new", "new")]
    other = [(k, u, "y" if k in (-70, 2000) else h) for k, u, h in other]
    schema = "page_id bigint, url string, html string"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    got = {r["id"]: r for r in fixity.audit(left, right).collect()}
    assert {k: r["status"] for k, r in got.items()} == {500: "missing", 501: "extra", -70: "changed", 2000: "changed"}

    def offset(rows, at):
        return sum(len(u) + len(h or "") for k, u, h in rows if k is not None and k < at)

    assert got[2000]["primary_offset"] == offset(rows, 2000)
    assert got[2000]["replica_offset"] == offset(other, 2000)
    assert got[500]["primary_offset"] == offset(rows, 500) and got[500]["replica_offset"] is None


def test_audit_of_equal_empty_and_null_records(spark):
    schema = "page_id bigint, url string, html string"
    rows = spark.createDataFrame([(1, "u", None), (None, None, None)], schema)
    assert fixity.audit(rows, rows).collect() == []
    assert {(r["id"], r["status"]) for r in fixity.audit(rows, rows.limit(0)).collect()} == {(1, "missing"), (None, "missing")}
    blank = spark.createDataFrame([(1, "u", ""), (None, None, None)], schema)
    assert [(r["id"], r["status"]) for r in fixity.audit(rows, blank).collect()] == [(1, "changed")]
    assert fixity.audit(rows.limit(0), rows.limit(0)).collect() == []


# Suffix dedup

def cut(spark, texts, length=400):
    docs = plain.documents(spark, texts).withColumn("key", F.lit(1)).withColumn("spans", F.lit(2))
    rows = suffix_dedup.remove_repeated_strings(docs, length=length).collect()
    return [(r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in sorted(rows, key=lambda r: r["row"])]


def test_repeats_like_plain_python(spark):
    picks = random.Random(6)
    prose = lambda n: "".join(picks.choice("abcdé \n") for _ in range(n))
    passage, other = prose(900), prose(420)
    near = list(prose(3000))
    texts = [prose(1500), passage, "x" + passage + prose(100), prose(50) + passage[:399], prose(7) + passage[300:760],
             other + prose(200) + other, "".join(near), None, "", "short", "ab" * 600, "z" * 1000, "same " * 100,
             "same " * 100, prose(399), passage[100:500]]
    for at in (10, 777, 1500, 1880, 2999):
        edited = list(near)
        edited[at] = "#"
        texts.append("".join(edited) + prose(30))
    assert cut(spark, texts) == plain.repeated_bytes(texts, 400)


def test_long_texts_come_in_pieces(spark, monkeypatch):
    picks = random.Random(7)
    monkeypatch.setattr(suffix_dedup, "PIECE", 5000)
    data = np.frombuffer("".join(picks.choice("abcd") for _ in range(23_000)).encode(), np.uint8)
    for length in (400,):
        whole = suffix_dedup.samples(data, np.array([0, len(data)]), length)[1:]
        import pyarrow as pa
        column, starts = pa.array([data.tobytes().decode()]), set()
        for _, part, offsets, base in suffix_dedup.pieces(column, length):
            sample, first, last = suffix_dedup.samples(part, offsets, length)[1:]
            starts |= {(s + base, p + base) for s, a, b in zip(sample, first, last, strict=True) for p in range(a, b + 1)}
        assert starts == {(s, p) for s, a, b in zip(*whole, strict=True) for p in range(a, b + 1)}


def test_repeats_in_texts_of_several_pieces(spark, monkeypatch):
    picks = random.Random(13)
    prose = lambda n: "".join(picks.choice("abcdé \n") for _ in range(n))
    passage = prose(900)
    long = prose(9000)
    edited = list(long)
    for at in range(500, 9000, 700):
        edited[at] = "#"
    texts = [long, "".join(edited), prose(4000) + passage + prose(3000), prose(1300) + passage[100:700], prose(7000),
             "q" + long[1500:6000] + prose(2500), "short", None]
    monkeypatch.setattr(suffix_dedup, "PIECE", 2000)
    cloudpickle.register_pickle_by_value(suffix_dedup)  # else workers import the module with its own PIECE
    try:
        assert cut(spark, texts) == plain.repeated_bytes(texts, 400)
    finally:
        cloudpickle.unregister_pickle_by_value(suffix_dedup)


def test_nothing_to_cut(spark):
    assert cut(spark, []) == []
    assert cut(spark, [None, "", "a"]) == [(0, 0, b""), (0, 0, b""), (1, 0, b"a")]


# SimHash

def test_fingerprints_like_plain_python(spark):
    texts = [None, "", " \t", "One", "a b c", "a b c d", "A\x0bb c d E f", "é É \u00a0x y z w", "w " * 3000,
             " ".join(map(str, range(70_000)))]
    docs = plain.documents(spark, texts)
    got = {r["doc_id"]: r["fingerprint"] % 2**64 for r in simhash.fingerprints(docs, keep=("doc_id",)).collect()}
    assert got == {k: plain.fingerprint(text) for k, text in enumerate(texts)}


def test_links_find_every_pair_within_four_bits(spark):
    picks = random.Random(8)
    values = {picks.getrandbits(64) for _ in range(150)} | {0, 2**64 - 1}
    for value in list(values)[:60]:
        for flips in range(1, 7):
            near = value
            for bit in picks.sample(range(64), flips):
                near ^= 1 << bit
            values.add(near)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fingerprint bigint").repartition(5))
    assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 4 for r in links.collect())
    got = {r["node"]: r["root"] for r in smallest_reachable(links).collect()}
    wanted = plain.components([v for v, in signed], lambda a, b: ((a ^ b) % 2**64).bit_count() <= 4)
    assert {v: got.get(v, v) for v, in signed} == wanted


def test_near_copies_share_the_smallest_id(spark):
    base = " ".join(f"word{k}" for k in range(3000))
    docs = plain.documents(spark, [(9, base), (4, base), (4, base), (None, base), (7, base + " end"), (2, None), (3, " "),
                                   (1, "quite another text about something else")])
    got = sorted(((r["row"] or 0), r["component"]) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, 4), (1, 1), (2, 2), (3, 2), (4, 4), (4, 4), (7, 4), (9, 4)]
    kept = simhash.one_of_each(docs.withColumn("root", F.lit(0)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    assert kept.columns == [*docs.columns, "root"]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    only_null = plain.documents(spark, [(None, "a b"), (None, "a b")])
    assert [r["component"] for r in simhash.near_duplicates(only_null).collect()] == [None, None]
    assert simhash.one_of_each(only_null).count() == 1


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000), (-3, 150)]
    got = {r["node"]: r["root"] for r in smallest_reachable(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: -3 for k in [*range(201), -3]}, **{1000 + k: 1000 for k in range(300)}}


# Mixing

def test_targets_are_cut_at_three_times_and_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 300), ("é", 7), (None, 0)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert sum(got.values()) == pytest.approx(417)
    assert got["a"] == 30 and got["é"] == 21 and got[None] == 0
    assert got["b"] / 2 == pytest.approx(got["c"] / 1)


def test_mix_meets_targets_in_whole_copies(spark):
    picks = random.Random(9)
    texts = ["w " * picks.choice([0, 1, 5, 5, 5, 40, picks.randint(1, 400)]) for _ in range(3000)] + [None, "x " * 5000]
    docs = plain.documents(spark, texts, ["s1", None, "s0", "s2", "s1"]).withColumn("size", F.lit("mine"))
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in rows)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["row"], r["taken"]) for r in again) == sorted((r["row"], r["taken"]) for r in rows)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_base_rates_are_tilted_together(spark):
    docs = plain.documents(spark, ["w " * (k % 50 + 1) for k in range(2000)], ["a", "b", "c"])
    rows = mixing.mix(docs, base=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).collect()
    for source in "abc":
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], abs=1)
        high, low = (next(r["rate"] for r in own if r["row"] % 2 == k) for k in (0, 1))
        assert high == pytest.approx(min(3, 4 * low))


def test_whole_rates_get_no_further_copy(spark):
    docs = plain.documents(spark, ["w " * (k % 50 + 1) for k in range(2000)], ["a", "b", "c"])
    rows = mixing.mix(docs, base=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).collect()
    assert any(r["rate"] == mixing.MOST for r in rows)
    assert all(r["copies"] <= mixing.MOST for r in rows)
    # What the size of 20 leaves owed would pay for two more of 9, whose rate is met.
    classes = pd.DataFrame({"source": "a", "size": [20, 9, 2], "n": [1, 3, 20], "rate": [0.9, 3.0, 0.5]})
    assert list(mixing.further_copies(classes)["given"]) == [0, 0, 19]


def test_rounds_are_bounded_whatever_the_bases(spark, monkeypatch):
    """Two classes of which the large one is at its limit long before the other one moves."""
    rounds = []
    monkeypatch.setattr(mixing, "shared", lambda frame: rounds.append(1) or shared(frame))
    for base, target in ((1e-3, 3001.5), (1e-6, 3001.5), (1e-6, 1.0), (1e6, 2.0)):
        classes = spark.createDataFrame([("a", 1.0, 1000.0), ("a", base, 1.0)], "source string, base double, tokens double")
        targets = spark.createDataFrame([("a", target)], "source string, target double")
        rounds.clear()
        rates = {r["base"]: r["rate"] for r in mixing.balanced_rates(classes, targets).collect()}
        assert 1000 * rates[1.0] + rates[base] == pytest.approx(target, rel=1e-8)
        assert len(rounds) <= 70


# Top-k

def test_top_k_like_numpy(spark):
    rng = np.random.default_rng(10)
    vectors = {k: rng.normal(0, 0.3, 70).tolist() for k in range(400)}
    vectors |= {500: None, 600: [None] * 70, 700: [float("nan")] * 70, 800: [float("inf")] * 70, 900: [], 3: [0.5] * 90,
                1000: vectors[0], 11: vectors[12]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<float>").repartition(3)
    whole = {k: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for k, v in vectors.items()
             if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    wanted = set()
    for q in (k for k in whole if k % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[k], strict=False)), k) for k in whole if k != q)
        wanted |= {(q, rank + 1, k, -s) for rank, (s, k) in enumerate(scores[:10])}
    got = topk.top_k(frame.withColumn("score", F.lit(1)), F.col("vec_id") % 100 == 0, block=3)
    assert {tuple(r) for r in got.collect()} == wanted
    for name in ("set", "slot", "query", "block", "n", "ids"):
        frame = frame.withColumn(name, F.lit("mine"))
    for block, query_set in ((64, 1), (65, 2), (8192, 64)):
        got = topk.top_k(frame, F.col("vec_id") % 100 == 0, block=block, query_set=query_set)
        assert {tuple(r) for r in got.collect()} == wanted


def test_a_written_index_answers_other_queries(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(k, rng.integers(-3, 4, 9).astype(float).tolist()) for k in range(300)]
    schema = "vec_id bigint, embedding array<double>"
    topk.build_index(spark.createDataFrame(rows, schema), scale=1, block=50).write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    asked = [(-1, [1.0] * 9), (-2, [-2.0] * 12), (-3, [0.0] * 4), (5, rows[5][1]), (None, [1.0]), (-4, None)]
    got = topk.search(index, spark.createDataFrame(asked, schema), scale=1, k=7).collect()
    wanted = set()
    for q, vector in asked[:4]:
        scores = sorted((-sum(int(a * b) for a, b in zip(vector, v, strict=False)), k) for k, v in rows if k != q)
        wanted |= {(q, rank + 1, k, -s) for rank, (s, k) in enumerate(scores[:7])}
    assert {tuple(r) for r in got} == wanted and len(got) == 28


def test_bit_maps_add_up_to_scores_of_any_size():
    rng = np.random.default_rng(4)
    for bits, width, n in ((40, 1, 3), (40, 5, 70), (12, 200, 130), (1, 3, 64)):
        values = rng.integers(-(1 << (bits - 1)), 1 << (bits - 1), (n, width))
        query = rng.integers(-(1 << min(bits, 20)), 1 << min(bits, 20), width)
        lows = values.min(axis=0)
        block = topk.Block({"n": n, "ids": np.arange(n).tobytes(), "lows": lows.tobytes(),
                            "slices": topk.slices(values - lows).tobytes()})
        exact = values @ query
        for k in (1, 2, n, n + 5):
            ids, score = block.best(-1, query, k)
            order = np.lexsort((np.arange(n), -exact))[:k]
            assert dict(zip(ids.tolist(), score.tolist(), strict=True)) == {int(r): int(exact[r]) for r in order}


def test_top_k_of_few_and_no_rows(spark):
    frame = spark.createDataFrame([(100, [1.0, 0.0]), (1, [2.0]), (1, [2.0]), (2, [-1.0])], "vec_id bigint, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == [(100, 1, 1, 2 << 20), (100, 2, 1, 2 << 20), (100, 3, 2, -1 << 20)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []


# Language model

@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_like_plain_python(spark, order):
    picks = random.Random(11)
    texts = [" ".join(picks.choice(["a", "B", "c,", "ö9"]) for _ in range(picks.randint(0, 30))) for _ in range(50)]
    texts += [None, "", "a a", "a a", "only once here", " ".join(str(k % 977) for k in range(30_000))]
    docs = plain.documents(spark, texts).withColumn("batch", F.lit("mine")).repartition(4)
    rows = sorted(lm_score.language_model_scores(docs, order=order).collect(), key=lambda r: r["row"])
    for row, (n, score) in zip(rows, plain.log_scores(texts, order), strict=True):
        assert row["n_words"] == n
        assert row["log_score"] == pytest.approx(score)
        assert (row["mean_log_score"] is None) == (n == 0)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_by_other_texts_like_plain_python(spark, order):
    picks = random.Random(5)
    texts = [" ".join(picks.choice(["a", "B", "c,", "ö9", "d", "e", "f"]) for _ in range(picks.randint(0, 30))) for _ in range(50)]
    texts += [None, "", "a a", "a a", "my own words", "my own my own words", "a new a", " ".join(str(k % 977) for k in range(5_000))]
    docs = plain.documents(spark, texts).repartition(4)
    rows = sorted(lm_score.language_model_scores(docs, order=order, by_others=True).collect(), key=lambda r: r["row"])
    for row, (n, score) in zip(rows, plain.log_scores_by_others(texts, order), strict=True):
        assert row["n_words"] == n
        assert row["log_score"] == pytest.approx(score)
        assert (row["mean_log_score"] is None) == (n == 0)


def test_a_text_alone_has_no_others(spark):
    docs = plain.documents(spark, [(None, "a b a"), (None, "")])
    rows = lm_score.language_model_scores(docs, by_others=True).collect()
    assert sorted((r["n_words"], r["log_score"]) for r in rows) == [(0, 0.0), (3, pytest.approx(5 * math.log(0.4)))]


def test_no_documents_have_no_scores(spark):
    assert lm_score.language_model_scores(plain.documents(spark, ["a"]).limit(0)).collect() == []

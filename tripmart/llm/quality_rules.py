"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Statistics are Spark columns over the whole text. A forest of shallow trees (Spark ML) is grown on labelled rows;
every path from a root, at any depth, becomes a conjunctive rule. A logistic regression with an L1 penalty (Spark ML)
weighs the rules and drops most, and what remains is compiled into one Spark column, so scoring is a projection
without Python, shuffle or model files.

Fitting uses all labelled rows given, distributed; nothing but rules and weights reaches the driver.

Defined results: null text counts as empty; all its statistics are 0 and it is scored like any other. Labels other
than 0 and 1 are ignored. Without labels of both kinds the score is the smoothed share of label 1, for every row.
Repeated rows are scored alike. Labels, language, source and ids are no input of a score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES, DEPTH, LASSO, SEED = 12, 3, 0.002, 17
THRESHOLD = 0.3

Condition = tuple[str, str, float]


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; each is a finite double, 0 for the empty text."""
    text = F.coalesce(text, F.lit(""))
    length = F.length(text)
    only = lambda kept: F.length(F.regexp_replace(text, f"[^{kept}]+", ""))
    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda word: word != "")
    n_words = F.size(words)
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
    share = lambda part, whole: part.cast("double") / F.greatest(whole, F.lit(1))
    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": share(length, n_words),
        "capitals": share(only(r"\p{Lu}"), length),
        "digits": share(only(r"\p{Nd}"), length),
        "symbols": share(length - F.length(F.regexp_replace(text, r"[^\p{L}\p{M}\p{Nd}\s.,]+", "")), length),
        "bars": share(F.regexp_count(text, F.lit(r"\|")), n_words),
        "marked_words": share(F.regexp_count(text, F.lit(r"[^\p{L}\p{M}\p{Nd}\s]{2,}+")), n_words),
        "stutter": share(F.regexp_count(text, F.lit(r"(?<!\S)(\S++)(?=\s\1(?!\S))")), n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_words": share(n_words, F.size(lines)),
    }


NAMES = (
    "log_words", "word_length", "capitals", "digits", "symbols", "bars", "marked_words", "stutter",
    "distinct_words", "distinct_lines", "line_words",
)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; a rule holds where all its conditions (statistic, "<=" or ">", bound) do."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, stats: dict[str, Column]) -> Column:
        """Share of confidence in label 1, as a column over the given statistics."""
        terms = [F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        total = reduce(lambda left, right: left + right, terms, F.lit(float(self.intercept)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: tuple[Condition, ...], stats: dict[str, Column]) -> Column:
    tests = [stats[name] <= bound if sign == "<=" else stats[name] > bound for name, sign, bound in rule]
    return reduce(lambda left, right: left & right, tests)


NODE = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def tree_rules(printed: str) -> set[tuple[Condition, ...]]:
    """Every path of a printed forest as a rule; of several bounds of one statistic the tightest."""
    rules, path = set(), []
    for line in printed.splitlines():
        if not (node := NODE.match(line)):
            continue
        depth = len(node[1])
        path = [step for step in path if step[0] < depth] + [(depth, (NAMES[int(node[2])], node[3], float(node[4])))]
        tight: dict[tuple[str, str], float] = {}
        for _, (name, sign, bound) in path:
            best = min if sign == "<=" else max
            tight[name, sign] = best(bound, tight.get((name, sign), bound))
        rules.add(tuple(sorted((name, sign, bound) for (name, sign), bound in tight.items())))
    return rules


def fit_rules(
    labelled: DataFrame, label: str, *, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED
) -> RuleModel:
    """labelled: one row per labelled text with the columns of NAMES and a label of 0 or 1."""
    rows = labelled.where(F.col(label).isin(0, 1)).select(*NAMES, F.col(label).cast("double").alias("label"))
    seen = rows.groupBy("label").count().collect()
    count = {int(row["label"]): row["count"] for row in seen}
    if len(count) < 2:
        share = (count.get(1, 0) + 1) / (sum(count.values()) + 2)
        return RuleModel(math.log(share / (1 - share)), ())
    vectors = VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", bootstrap=False, seed=seed
    ).fit(vectors)
    rules = sorted(tree_rules(forest.toDebugString))
    if not rules:
        share = (count[1] + 1) / (sum(count.values()) + 2)
        return RuleModel(math.log(share / (1 - share)), ())
    stats = {name: F.col(name) for name in NAMES}
    indicators = rows.select(
        "label", *[holds(rule, stats).cast("double").alias(f"rule_{k}") for k, rule in enumerate(rules)]
    )
    fired = VectorAssembler(inputCols=[f"rule_{k}" for k in range(len(rules))], outputCol="features")
    line = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(fired.transform(indicators))
    weighed = zip(rules, line.coefficients.toArray().tolist(), strict=True)
    return RuleModel(line.intercept, tuple((rule, weight) for rule, weight in weighed if weight != 0.0))


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """The rows no label is learned from: one part of `parts`, by the id's CRC-32; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(True))


def with_statistics(docs: DataFrame, *keep: str, text_column: str = "text") -> DataFrame:
    stats = statistics(F.col(text_column))
    return docs.select(*keep, *[stats[name].alias(name) for name in NAMES])


def training_rows(stats: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", label: str = "quality") -> DataFrame:
    known = labels.select(F.col(id_column), F.col(label).alias("label_")).where(F.col("label_").isin(0, 1))
    return stats.where(~held_out(F.col(id_column))).join(known, id_column)

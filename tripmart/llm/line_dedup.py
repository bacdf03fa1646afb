"""Line dedup over overlapping three-line windows.

Every window of `width` consecutive lines is hashed (two XXH64 with different seeds, 128 bits). Windows that occur
more than once anywhere are found by one aggregation with map-side combine; of each, the first occurrence by
(doc_id, text key, line number) stays and the lines of every later occurrence are removed, covered positions of
overlapping windows being merged. A frequent window is one row per task in the aggregation, and its occurrences
return to their documents by a join that adaptive execution splits.

Defined results: lines end at "\\n" only. A text of fewer lines than `width`, empty or null, has no window and stays as
it is. Null ids order first. Rows repeated with the same id and text count as one occurrence, so they are treated
alike. A text all of whose lines go becomes empty; the row stays. Texts of any length are taken whole. An empty table gives no
rows. Columns of the input are kept, whatever their names, but for n_lines and n_removed, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import own, text_key

WIDTH = 3


def bound(value: Column, body) -> Column:
    """body(value) with value worked out once per row, also where body uses it within a loop."""
    return F.element_at(F.transform(F.array(value), body), 1)


def windows(lines: Column, width: int) -> Column:
    """Array of (position, h1, h2), one per window; empty for shorter texts."""
    def one(lines: Column, at: Column) -> Column:
        part = [F.get(lines, at + k) for k in range(width)]
        return F.struct(at.alias("at"), F.xxhash64(*part).alias("h1"),
                        F.xxhash64(F.lit("second"), *part).alias("h2"))

    last = F.size(lines) - width
    return F.when(
        last >= 0, bound(lines, lambda kept: F.transform(F.sequence(F.lit(0), last), lambda at: one(kept, at)))
    )


def remove_repeated_lines(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH
) -> DataFrame:
    """The documents with their remaining text, and the columns n_lines and n_removed at the end."""
    doc, key, lines, of, of_key, covers = (
        own(name, docs.columns) for name in ("doc", "key", "lines", "of", "of_key", "covered"))
    text = F.col(text_column)
    keyed = docs.withColumns({key: text_key(text), doc: F.col(id_column)})
    occurrences = (
        docs.select(F.col(id_column).alias("doc"), text_key(text).alias("key"), F.split(text, "\n", -1).alias("lines"))
        .where(F.size("lines") >= width)
        .select("doc", "key", F.inline(windows(F.col("lines"), width)))
    )
    where = F.struct("doc", "key", "at")
    repeated = (
        occurrences.groupBy("h1", "h2")
        .agg(F.min(where).alias("first"), F.max(where).alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("h1", "h2", "first")
    )
    later = (
        occurrences.join(repeated, ["h1", "h2"])
        .where(where > F.col("first"))
        .groupBy("doc", "key").agg(F.collect_set("at").alias("starts"))
        .select(F.col("doc").alias(of), F.col("key").alias(of_key), "starts")
    )
    covered = F.flatten(F.transform("starts", lambda at: F.sequence(at, at + width - 1)))
    found = later.select(of, of_key, F.array_distinct(covered).alias(covers))
    n_lines, gone = F.size(F.col(lines)), F.col(covers)
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), gone)
    remaining = bound(F.col(lines), lambda kept: F.array_join(F.transform(stay, lambda at: F.get(kept, at)), "\n"))
    return (
        keyed.join(found, F.col(doc).eqNullSafe(F.col(of)) & (F.col(key) == F.col(of_key)), "left")
        .withColumn(lines, F.split(text, "\n", -1))
        .select(
            *[F.when(gone.isNull(), text).otherwise(remaining).alias(name) if name == text_column else F.col(f"`{name}`")
              for name in docs.columns if name not in ("n_lines", "n_removed")],
            F.coalesce(F.when(text.isNotNull(), n_lines), F.lit(0)).alias("n_lines"),
            F.coalesce(F.when(gone.isNotNull(), F.size(gone)), F.lit(0)).alias("n_removed"),
        )
    )

"""Exact dedup by skew-safe combining.

Copies are removed in three steps, each a hash aggregation whose key holds
the full normalised content, so equal digests alone never make two texts
equal:

1. *local*: the map side of the first aggregation leaves one row per
   content, salt and input partition;
2. *salted*: rows meet on (digest, salt, content), so that a text held by a
   third of all rows is merged by ``salts`` tasks and not by one;
3. *global*: the winners of the salts, at most ``salts`` per content, meet on
   (digest, content).

Every document then learns its group through (digest, salt), where the group
table has one row per salt that really occurs: a hot group is looked up in as
many partitions as it has salts, and the texts do not move a third time.  Two
contents under one SHA-256 digest would show in step 3; the job then fails
with a message instead of merging them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The characters that normalisation deletes (fixed value): space and 0x09-0x0D.
BLANKS = " \t\n\x0b\x0c\r"


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row per document with the group of its text.

    Texts are equal when they agree after deleting ``[\\x20\\x09-\\x0D]``; null
    counts as empty, so null, empty and blank texts are one group.  The row
    with the most code points in the original text stays; ties go to the
    smallest id, and a null id loses against any other.  Of fully repeated
    rows (same id, same length) all are marked as kept, since nothing tells
    them apart.  Other columns are not looked at; an empty table gives no rows.

    Returns ``id_col, keep_id, group_size, kept, text_sha256, n_points``.
    """
    content = F.translate(F.coalesce(F.col(text_col), F.lit("")), BLANKS, "")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_points"),
        content.alias("_content"),
        F.sha2(content, 256).alias("_digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("_salt"),
    )
    # Larger is better: more code points, then a smaller id; a null id comes last.
    # (minus one minus id: the negation that no long overflows)
    rank = F.struct("_points", (F.lit(-1) - F.col("_id")).alias("_order"))
    salted = rows.groupBy("_digest", "_salt", "_content").agg(
        F.max(rank).alias("_best"), F.count(F.lit(1)).alias("_size"))
    # At most ``salts`` rows per content are left, so the digest alone may deal them out.
    merged = salted.repartition("_digest").groupBy("_digest", "_content").agg(
        F.max("_best").alias("_best"), F.sum("_size").alias("_size"), F.collect_set("_salt").alias("_salts"))
    groups = merged.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_contents"), F.max("_best").alias("_best"),
        F.sum("_size").alias("group_size"), F.flatten(F.collect_list("_salts")).alias("_salts"))
    table = groups.select(
        "_digest",
        F.explode(F.when(F.col("_contents") == 1, F.col("_salts")).otherwise(
            F.raise_error(F.concat(F.lit("two contents with digest "), F.col("_digest"))).cast("array<int>"))
        ).alias("_salt"),
        "_best", "group_size")
    return (
        rows.drop("_content").join(table, ["_digest", "_salt"])
        .select(
            F.col("_id").alias(id_col),
            (F.lit(-1) - F.col("_best._order")).alias("keep_id"),
            "group_size",
            F.col("_points").alias("n_points"),
            F.col("_best._points").alias("_most"),
            F.col("_digest").alias("text_sha256"),
        )
        .select(
            id_col, "keep_id", "group_size",
            ((F.col("n_points") == F.col("_most")) & F.col(id_col).eqNullSafe(F.col("keep_id"))).alias("kept"),
            "text_sha256", "n_points",
        )
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per group of
    equal texts (see :func:`exact_groups`), fully repeated rows once."""
    kept = exact_groups(docs, id_col, text_col, salts).where("kept").select(
        F.col(id_col).alias("__keep"), F.col("text_sha256").alias("__sha"), F.col("n_points").alias("__points"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({
        "__row_sha": F.sha2(F.translate(text, BLANKS, ""), 256), "__row_points": F.length(text)})
    same = (F.col(id_col).eqNullSafe(F.col("__keep")) & (F.col("__row_sha") == F.col("__sha"))
            & (F.col("__row_points") == F.col("__points")))
    return keyed.join(kept, same, "left_semi").dropDuplicates([id_col, "__row_sha"]).drop("__row_sha", "__row_points")

"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only column functions run here.  The first pass over the texts takes lengths
and hashes of prefixes; the second hashes whole texts, and only those whose
length and prefix occur more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm import marks
from spotweave.session import settle

PREFIX = 128  # characters hashed before a whole text is


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty; other letters stay as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalised(text), 256)


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, all_digests: bool = False
) -> DataFrame:
    """One row per row of ``df``: ``id_col, keep_id, group_size, kept, n_bytes, full_hash``.

    Of rows with equal normalised texts the one with the largest id stays.
    Null texts equal empty ones.  Rows without an id never stay beside one with
    an id; rows repeated with the id that stays are flagged alike.  A group
    without any id keeps all its rows.  ``full_hash`` is null where length and
    prefix alone proved a text unique; ``all_digests`` hashes such texts too,
    for output only.  Other columns are ignored.
    """
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    size = F.octet_length(F.coalesce("_text", F.lit("")))
    start = F.xxhash64(normalised(F.substring("_text", 1, prefix)))

    # Level 1, length, and level 2, length and prefix hash: counts only, combined before they move.
    by_prefix = texts.groupBy(size.alias("_size"), start.alias("_start")).agg(F.count(F.lit(1)).alias("_n"))
    by_prefix = settle(by_prefix, "prefixes")
    by_size = by_prefix.groupBy("_size").agg(F.sum("_n").alias("_all")).where("_all > 1")
    open_groups = by_prefix.where("_n > 1").join(by_size, "_size", "left_semi")

    # Level 3: whole texts are hashed in the groups still open; the marks are a bounded superset of these.
    key = F.xxhash64("_size", "_start")
    noted = marks.marked(open_groups.select(key.alias("_key")), "_key")
    keyed = marks.with_marks(texts.select("_id", "_text", size.alias("_size"), F.xxhash64(size, start).alias("_key")), "_key", noted)
    hashed = F.unhex(digest(F.col("_text")))
    shown = hashed if all_digests else F.when(F.col("_passes"), hashed)
    rows = settle(keyed.select("_id", "_size", "_passes", shown.alias("_shown")), "hashes")
    rows = rows.withColumn("_full", F.when(F.col("_passes"), F.col("_shown")))

    suspects = rows.where(F.col("_full").isNotNull())
    groups = suspects.groupBy("_size", "_full").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    groups = settle(groups, "groups")  # a table of its own, so that the join can split a group's rows
    # A text that no mark let through is alone; its length spreads it in the join.
    found = rows.join(groups, ["_size", "_full"], "left")
    single = F.col("_full").isNull()
    keep = F.when(single, F.col("_id")).otherwise(F.col("_keep"))
    return found.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.when(single, F.lit(1)).otherwise(F.col("_n")).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_size").cast("long").alias("n_bytes"),
        F.lower(F.hex("_shown")).alias("full_hash"),
    )


def drop_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    groups = exact_groups(df, id_col, text_col).where(~F.col("kept"))
    dropped = groups.select(F.col(id_col).alias("dropped_id"), F.col("full_hash").alias("dropped_hash")).distinct()
    same = df[id_col].eqNullSafe(dropped["dropped_id"]) & (digest(df[text_col]) == dropped["dropped_hash"])
    return df.join(dropped, same, "left_anti")

"""Codebooks: gene names, base sequences and their 0/1 codes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from spotweave.functions.vectors import one_hot
from spotweave.operators.ranking import number_rows

# Channel order of the codes and the prefix of negative controls.
CODE_BASES = ("G", "T", "A", "C")
CONTROL_PREFIX = "unused"


MAX_CODES = 100_000  # rows of a codebook that may reach the driver


def short_rows(codebook: DataFrame) -> list[Row]:
    """Rows in gene order.  A codebook is a short list; its size is checked before it reaches the driver."""
    rows = codebook.orderBy("gene_id").limit(MAX_CODES + 1).collect()
    if len(rows) > MAX_CODES:
        raise ValueError(f"codebook has more than {MAX_CODES} rows")
    return rows


def binary_codes(codebook: DataFrame, n_cycles: int = 7, bases: Sequence[str] = CODE_BASES) -> DataFrame:
    """0/1 code of every gene, one slot per cycle and channel."""
    return codebook.select("gene_id", "gene", one_hot("sequence", bases, n_cycles).alias("code"))


def is_control(gene: str = "gene") -> Column:
    return F.col(gene).startswith(CONTROL_PREFIX)


def add_controls(codebook: DataFrame, n: int, length: int, bases: str = "ACGT") -> DataFrame:
    """Codebook with ``n`` control genes on sequences it does not use.

    The choice is the ``n`` lowest by hash, so a rerun picks the same ones.
    """
    size = len(bases)
    letters = F.array(*[F.lit(b) for b in bases])
    digits = [F.get(letters, (F.floor(F.col("id") / size**p) % size).cast("int")) for p in range(length - 1, -1, -1)]
    words = codebook.sparkSession.range(size**length).select(F.concat(*digits).alias("sequence"))
    free = words.join(codebook.select("sequence"), "sequence", "left_anti")
    picked = free.orderBy(F.md5("sequence"), "sequence").limit(n)
    last = codebook.agg(F.max("gene_id").alias("m")).scalar()
    named = number_rows(picked, [F.md5("sequence"), F.col("sequence")], "_i").select(
        (last + 1 + F.col("_i")).cast("int").alias("gene_id"),
        F.concat(F.lit(f"{CONTROL_PREFIX}-"), (F.col("_i") + 1).cast("string")).alias("gene"),
        "sequence",
    )
    return codebook.select("gene_id", "gene", "sequence").unionByName(named)


def combine_codebooks(books: Sequence[DataFrame]) -> DataFrame:
    """One codebook; the ids of each part follow those of all parts before it."""
    columns = ["gene_id", "gene", "sequence"]
    shifted = [books[0].select(*columns)]
    for k in range(1, len(books)):
        sizes = [b.agg(F.count(F.lit(1)).alias("n")).scalar() for b in books[:k]]
        offset = reduce(lambda a, b: a + b, sizes)
        shifted.append(books[k].select(*columns).withColumn("gene_id", (F.col("gene_id") + offset).cast("int")))
    return reduce(lambda a, b: a.unionByName(b), shifted)


def name_genes(spots: DataFrame, codebook: DataFrame) -> DataFrame:
    """Attach gene names; the codebook is small and the optimizer sees its size."""
    return spots.join(codebook.select("gene_id", "gene"), "gene_id")


def gene_of_channel(codebook: DataFrame) -> DataFrame:
    """Channel number of each hybridisation gene, from its one-letter sequence."""
    return codebook.select(F.col("sequence").cast("int").alias("channel"), "gene_id", "gene")

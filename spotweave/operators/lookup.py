"""A large table joined with one that has few rows beside it, such as one per plane."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.session import settle

SENT = 16 << 20  # bytes of a table that may be sent to every task; hashed it takes about three times as many


def looked_up(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of ``df`` with ``table``, in which ``df`` is never sent or hashed.

    Before its rows are listed ``df`` may look the smaller side, and an
    aggregate as large as what it was made from.  So ``table`` is written first
    and its rows counted: it is sent to all tasks if it is small, and hashed by
    key part by part if not.
    """
    table = settle(table, "lookup")
    small = table.count() * 8 * (len(table.columns) + 1) <= SENT
    return df.join(F.broadcast(table) if small else table.hint("shuffle_hash"), list(keys))

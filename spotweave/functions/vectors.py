"""Column expressions over per-channel signals and base sequences.

Channels are kept as separate scalar columns wherever their number is fixed,
so the expressions stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strongest(signals: Sequence[ColumnOrName]) -> Column:
    """Largest of the channel signals."""
    cols = [as_col(s) for s in signals]
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def called_channel(signals: Sequence[ColumnOrName]) -> Column:
    """1-based number of the strongest channel; the first one wins a tie."""
    cols = [as_col(s) for s in signals]
    top = strongest(cols)
    call = F.lit(len(cols))
    for number in range(len(cols) - 1, 0, -1):
        call = F.when(cols[number - 1] == top, F.lit(number)).otherwise(call)
    return call


def l2_norm(signals: Sequence[ColumnOrName]) -> Column:
    squares = [as_col(s).cast("double") * as_col(s).cast("double") for s in signals]
    return F.sqrt(reduce(lambda a, b: a + b, squares))


def call_score(signals: Sequence[ColumnOrName], undefined: float = 0.5) -> Column:
    """Strongest signal over the L2 norm; ``undefined`` where all channels are 0."""
    ratio = F.try_divide(strongest(signals).cast("double"), l2_norm(signals))
    return F.coalesce(ratio, F.lit(float(undefined)))


def to_uint16(value: ColumnOrName) -> Column:
    """Round half to even and clip to the 16-bit range."""
    rounded = F.rint(as_col(value))
    return F.least(F.greatest(rounded, F.lit(0.0)), F.lit(65535.0)).cast("int")


def kth_lowest(values: ColumnOrName, k: int) -> Column:
    """k-th lowest array element, or the highest when there are fewer."""
    v = F.array_sort(as_col(values))
    return F.get(v, F.least(F.lit(k), F.size(v)) - 1)


def array_norm(values: ColumnOrName) -> Column:
    return F.sqrt(F.aggregate(as_col(values), F.lit(0.0), lambda s, x: s + x * x))


def hamming(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Differing positions of two strings over their common prefix."""
    a, b = as_col(a), as_col(b)
    shared = F.least(F.length(a), F.length(b))
    return F.when(
        shared > 0,
        F.aggregate(
            F.sequence(F.lit(1), F.greatest(shared, F.lit(1))),
            F.lit(0),
            lambda n, p: n + (F.substr(a, p, F.lit(1)) != F.substr(b, p, F.lit(1))).cast("int"),
        ),
    ).otherwise(F.lit(0))


def subword_usage(seq: ColumnOrName) -> Column:
    """Distinct sub-words of every length over the most there could be."""
    s = as_col(seq)
    n = F.length(s)

    def usage(i: Column) -> Column:
        starts = n - i + 1
        words = F.transform(F.sequence(F.lit(1), starts), lambda p: F.substr(s, p, i))
        most = F.least(F.pow(F.lit(4.0), i), starts.cast("double"))
        return F.size(F.array_distinct(words)) / most

    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), usage)).otherwise(
        F.array().cast("array<double>")
    )


def complexity_score(seq: ColumnOrName) -> Column:
    """log10 of the product of the sub-word usages; 0 means fully complex."""
    return F.log10(F.aggregate(subword_usage(seq), F.lit(1.0), lambda a, x: a * x))


def similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Smaller over larger of two whole numbers to 3 places; a lone 0 lifts both by 1."""
    a, b = as_col(a).cast("long"), as_col(b).cast("long")
    lift = F.when((a == 0) | (b == 0), F.lit(1)).otherwise(F.lit(0))
    lo, hi = F.least(a + lift, b + lift), F.greatest(a + lift, b + lift)
    return F.when(a == b, F.lit(1.0)).otherwise(F.round(lo / hi, 3))


def one_hot(seq: ColumnOrName, bases: Sequence[str], n_cycles: int) -> Column:
    """0/1 code, cycle-major then channel, of the first ``n_cycles`` bases."""
    s = as_col(seq)
    bits = [
        (F.substr(s, F.lit(p), F.lit(1)) == F.lit(base)).cast("int")
        for p in range(1, n_cycles + 1)
        for base in bases
    ]
    return F.array(*bits)

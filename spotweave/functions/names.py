"""Column expressions on file and tile names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spotweave.functions.vectors import as_col

# How directories and tiles are named.
MODE_PATTERNS = {"geneseq": r"geneseq(.*)", "hyb": r"hyb(.*)", "bcseq": r"bcseq(.*)"}
TILE_PATTERNS = (r"MAX_Pos(\d*)_(\d*)_(\d*)",)


def first_match(text: str | Column, patterns: Sequence[str], group: int = 0) -> Column:
    """Group of the first pattern that is found in the text, null when none is."""
    t = as_col(text)
    found = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        found = F.when(t.rlike(pattern), F.regexp_extract(t, pattern, group)).otherwise(found)
    return found


def natural_key(text: str | Column) -> Column:
    """Sort key in which digit runs compare as numbers, so Pos2 comes before Pos10."""
    runs = F.regexp_extract_all(as_col(text), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.transform(runs, lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x))


def directory(path: str | Column) -> Column:
    return F.regexp_extract(as_col(path), r"^(.*)/[^/]*$", 1)


def file_name(path: str | Column) -> Column:
    return F.element_at(F.split(as_col(path), "/"), -1)


def _stem(path: str | Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: str | Column) -> Column:
    """Extension without its dot; null when there is none."""
    return F.nullif(F.regexp_extract(file_name(path), r".\.([^.]*)$", 1), F.lit(""))


def long_label(path: str | Column) -> tuple[Column, Column]:
    """Base up to the first dot, and everything between it and the extension as the label."""
    stem = _stem(path)
    base = F.element_at(F.split(stem, r"\."), 1)
    label = F.when(F.contains(stem, F.lit(".")), F.regexp_replace(stem, r"^[^.]*\.", ""))
    return base, label


def last_label(path: str | Column) -> tuple[Column, Column]:
    """Everything up to the last dotted part as the base, and that part as the label."""
    stem = _stem(path)
    dotted = F.contains(stem, F.lit("."))
    base = F.when(dotted, F.regexp_replace(stem, r"\.[^.]*$", "")).otherwise(stem)
    return base, F.when(dotted, F.element_at(F.split(stem, r"\."), -1))


def output_path(path: str | Column, label: str | None = None, ext: str | None = None) -> Column:
    """Path of a one-to-one output: the same directory and base, a new label or extension."""
    if label is None and ext is None:
        return as_col(path)
    base, _ = long_label(path)
    end = F.lit(ext) if ext is not None else extension(path)
    name = F.concat_ws(".", base, F.lit(label) if label is not None else F.lit(None).cast("string"), end)
    return F.concat_ws("/", directory(path), name)


def merged_output_path(
    path: str | Column, mode: str, label: str | None = None, ext: str | None = None, strip_base: bool = False
) -> Column:
    """Path of a many-to-one output, named after the first input, in the directory of the mode."""
    base, _ = long_label(path)
    end = F.lit(ext) if ext is not None else extension(path)
    parts = [] if strip_base and label is not None else [base]
    if label is not None:
        parts.append(F.lit(label))
    return F.concat_ws("/", F.lit(mode), F.concat_ws(".", *parts, end))

"""Fixity audit of WARC replicas by Merkle trees over record hashes and ordered offset ranges.

A leaf is the hash of a record's bytes with its range of offsets.  ``FANOUT``
neighbours make a node that hashes their hashes and the range they cover, up to
one root per file and one per replica.  The audit compares the roots and only
goes down where hashes differ, so intact branches are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotweave.session import settle

_FANOUT_BITS = 4
FANOUT = 1 << _FANOUT_BITS
RECORDS = 1000  # records of a file, on average
_GAP = "\r\n\r\n"  # after each record


def warc_record(url: Column, body: Column, record_id: Column) -> Column:
    """A WARC resource record without its closing gap; a null url or body is empty."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
    )
    return F.concat(head, F.lit(_GAP), body)


def records(df: DataFrame, id_col="page_id", url_col="url", body_col="html", per_file: int = RECORDS) -> DataFrame:
    """Records in files: ``file, nth, start, size, id, digest``.

    Rows are dealt to files by a hash of id, url and size, ``per_file`` on
    average, and stand there in order of id (null first) and digest; ``start``
    is the byte offset.  Rows that repeat an id are records of their own.
    Other columns are ignored.
    """
    hashed = settle(digests(df, id_col, url_col, body_col), "records")
    return in_files(hashed.withColumn("file", F.pmod("deal", F.lit(file_count(hashed.count(), per_file)))).drop("deal"))


def digests(df: DataFrame, id_col="page_id", url_col="url", body_col="html") -> DataFrame:
    """Records wherever they stand: ``id, deal, digest, size``."""
    record = warc_record(F.col(url_col), F.col(body_col), F.col(id_col))
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), record.alias("record"))
    size = (F.octet_length("record") + len(_GAP)).cast("long")
    return rows.select("id", F.xxhash64("id", "url", size).alias("deal"), F.unhex(F.sha2("record", 256)).alias("digest"), size.alias("size"))


def file_count(rows: int, per_file: int = RECORDS) -> int:
    return max(1, -(-rows // per_file))


def in_files(hashed: DataFrame) -> DataFrame:
    """Number and offset of each record in its file."""
    order = Window.partitionBy("file").orderBy("id", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn("nth", (F.row_number().over(order) - 1).cast("long"))
    return placed.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))


def write_warc(df: DataFrame, path: str, id_col="page_id", url_col="url", body_col="html") -> None:
    """Write the rows as WARC text files, one per partition."""
    df.select(warc_record(F.col(url_col), F.col(body_col), F.col(id_col)).alias("value")).write.option("lineSep", _GAP).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of written files: ``file`` (part number), ``nth, start, size, id, digest``; a file is read by one task."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, data in zip(frame["file"], frame["content"]):
                at, rows = 0, []
                while at < len(data):
                    head = data.index(b"\r\n\r\n", at) + 4
                    fields = dict(line.split(b": ", 1) for line in data[at : head - 4].split(b"\r\n")[1:])
                    end = head + int(fields[b"Content-Length"])
                    own = fields[b"WARC-Record-ID"].decode()[len("<urn:page:") : -1]
                    digest = hashlib.sha256(data[at:end]).digest()
                    rows.append((number, len(rows), at, end + 4 - at, int(own) if own else None, digest))
                    at = end + 4
                yield pd.DataFrame(rows, columns=["file", "nth", "start", "size", "id", "digest"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content")
    return files.mapInPandas(parse, "file long, nth long, start long, size long, id long, digest binary")


def height(most: int) -> int:
    """Levels above ``most`` + 1 neighbours until one is left."""
    levels = 0
    while most > 0:
        most, levels = most // FANOUT, levels + 1
    return levels


def merkle_levels(placed: DataFrame, inner: int, outer: int) -> list[DataFrame]:
    """Nodes ``file, node, first, last, digest`` from the leaves to one root.

    ``inner`` levels join neighbours of a file, ``outer`` levels the files by
    number.  ``first`` and ``last`` are the range a node covers, in bytes and
    above the files' roots in files.  Each level is a written table, up to
    ``FANOUT`` times smaller than the one below.
    """
    own = F.encode(F.concat_ws(":", "start", "size"), "utf-8")
    leaf = F.unhex(F.sha2(F.concat(F.col("digest"), own), 256)).alias("digest")
    ends = [F.col("start").alias("first"), (F.col("start") + F.col("size")).alias("last")]
    levels = [settle(placed.select(F.col("file").cast("long"), F.col("nth").alias("node"), *ends, leaf), "leaves")]
    for level in range(inner + outer):
        levels.append(settle(_above(levels[-1], level < inner), "nodes"))
    return levels


def _parent(inner: bool) -> list[Column]:
    """Key of a node's parent."""
    up = lambda c: F.shiftright(c, _FANOUT_BITS).alias(c)
    return [F.col("file"), up("node")] if inner else [up("file"), F.col("node")]


def _above(level: DataFrame, inner: bool) -> DataFrame:
    """Parents of a level's nodes; a parent has at most FANOUT children, so its list is short."""
    at = "node" if inner else "file"
    low, high = ("first", "last") if inner else (at, at)
    child = F.struct(F.col(at).alias("at"), F.col(low).alias("first"), F.col(high).alias("last"), "digest")
    listed = level.groupBy(*_parent(inner)).agg(F.array_sort(F.collect_list(child)).alias("c"))
    shown = lambda x: F.concat(F.encode(F.concat_ws(":", x["at"], x["first"], x["last"]), "utf-8"), x["digest"])
    joined = F.aggregate("c", F.lit(b""), lambda a, x: F.concat(a, shown(x)))
    first = F.array_min(F.transform("c", lambda x: x["first"])).alias("first")
    last = F.array_max(F.transform("c", lambda x: x["last"])).alias("last")
    return listed.select("file", "node", first, last, F.unhex(F.sha2(joined, 256)).alias("digest"))


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``file, nth`` of the records in which two replicas differ, found by going down from their roots.

    Both are tables ``file, nth, start, size, digest``.  A record that only one
    replica has differs.  Empty replicas have no root and all of the other's
    records differ.
    """
    both = ours.select("file", "nth").union(theirs.select("file", "nth")).agg(F.max("file").alias("file"), F.max("nth").alias("nth")).first()
    inner, outer = height(both["nth"] or 0), height(both["file"] or 0)
    left, right = (merkle_levels(replica, inner, outer) for replica in (ours, theirs))
    differ = None
    for depth in range(inner + outer, -1, -1):
        a = left[depth].select("file", "node", F.col("digest").alias("a"))
        b = right[depth].select("file", "node", F.col("digest").alias("b"))
        if differ is not None:  # only the children of nodes that differ
            up = differ.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            below = [key == up[f"up_{c}"] for key, c in zip(_parent(depth < inner), ("file", "node"))]
            a, b = (side.join(up, below, "left_semi") for side in (a, b))
        differ = settle(a.join(b, ["file", "node"], "full_outer").where("NOT (a <=> b)").select("file", "node"), "differ")
    return differ.withColumnRenamed("node", "nth")


def laid_out(ours: DataFrame, theirs: DataFrame, files: int) -> DataFrame:
    """A replica on our manifest: ``file, nth, start, id, size, digest, their_size, their_digest``.

    ``ours`` has places, ``theirs`` is ``id, deal, digest, size``.  Records are
    paired by id, among those that repeat an id equal ones first.  A record
    that the replica lacks has null in their columns; one that only the replica
    has is null in ours and stands after the manifest's records of a file.
    """

    def pairs(a: DataFrame, b: DataFrame, by: list[str], order: list[str]) -> DataFrame:
        sides = []
        for side, own in ((a, "a"), (b, "b")):
            nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
            sides.append(side.withColumn("_turn", nth).select(*[F.col(c).alias(f"{own}_{c}") for c in [*side.columns, "_turn"]]))
        same = [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in [*by, "_turn"]]
        return sides[0].join(sides[1], same, "full_outer").drop("a__turn", "b__turn")

    places, records_ = ["file", "nth", "start", "id", "size", "digest"], ["id", "deal", "digest", "size"]
    equal = settle(pairs(ours.select(*places), theirs.select(*records_), ["id", "digest"], ["size"]), "paired")
    left = equal.where("b_digest IS NULL").select(*[F.col(f"a_{c}").alias(c) for c in places])
    right = equal.where("a_digest IS NULL").select(*[F.col(f"b_{c}").alias(c) for c in records_])
    rest = settle(pairs(left, right, ["id"], ["digest"]), "paired")
    known = equal.where("a_digest IS NOT NULL AND b_digest IS NOT NULL").unionByName(rest.where("a_digest IS NOT NULL"))
    their = [F.col("b_size").alias("their_size"), F.col("b_digest").alias("their_digest")]
    known = known.select(*[F.col(f"a_{c}").alias(c) for c in places], *their)

    extra = rest.where("a_digest IS NULL").select(F.pmod("b_deal", F.lit(files)).alias("file"), F.col("b_id").alias("id"), *their)
    ends = ours.groupBy("file").agg((F.max("nth") + 1).alias("records"), F.max(F.col("start") + F.col("size")).alias("bytes"))
    order = Window.partitionBy("file").orderBy("id", "their_digest")
    before = F.coalesce(F.sum("their_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = extra.withColumn("nth", F.row_number().over(order) - 1).withColumn("start", before).join(ends, "file", "left")
    nth = (F.col("nth") + F.coalesce("records", F.lit(0))).cast("long").alias("nth")
    start = (F.col("start") + F.coalesce("bytes", F.lit(0))).cast("long").alias("start")
    none = [F.lit(None).cast("long").alias("size"), F.lit(None).cast("binary").alias("digest")]
    return known.unionByName(extra.select("file", nth, start, "id", *none, "their_size", "their_digest"))


def audited(df: DataFrame, replica: DataFrame, id_col="page_id", url_col="url", body_col="html") -> DataFrame:
    """Each record of ``df`` and each that only the replica has, with ``damaged``: whether the replica's record of that id differs.

    Columns: ``id_col, file, nth, start, size, digest`` (lowercase hex),
    ``damaged``, ``state`` (intact, changed, missing or extra).  Both sides stand
    on the manifest of ``df``, so a record of another length, a lost or an added
    one moves no other.  Extra records show the replica's size and digest.
    """
    hashed = settle(digests(df, id_col, url_col, body_col), "records")
    files = file_count(hashed.count())
    ours = settle(in_files(hashed.withColumn("file", F.pmod("deal", F.lit(files))).drop("deal")), "ours")
    theirs = settle(digests(replica, id_col, url_col, body_col), "theirs")
    laid = settle(laid_out(ours, theirs, files), "laid")
    held = laid.where("their_digest IS NOT NULL").select("file", "nth", "start", F.col("their_size").alias("size"), F.col("their_digest").alias("digest"))
    found = audit(ours, held).withColumn("_found", F.lit(True))
    state = F.when(F.col("_found").isNull(), "intact").when(F.col("digest").isNull(), "extra").when(F.col("their_digest").isNull(), "missing").otherwise("changed")
    size, digest = F.coalesce("size", "their_size").alias("size"), F.lower(F.hex(F.coalesce("digest", "their_digest"))).alias("digest")
    shown = [F.col("id").alias(id_col), "file", "nth", "start", size, digest, F.coalesce("_found", F.lit(False)).alias("damaged"), state.alias("state")]
    return laid.join(found, ["file", "nth"], "left").select(*shown)

"""Experiment-shaped inputs derived from the given tables.

Each entry is one SQL text that both Spark and the checking database run, so
the two sides start from the same rows.  Integer arithmetic only.  ``//`` is
whole division, ``lambda x:`` a lambda and ``each(a, b)`` one row per number;
``spark_text`` and ``check_text`` put these into the two dialects.

Every input reads its whole source table, and tiles, slices and files grow in
number with it while the density inside a tile stays the same.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Fixed values of the derivation.
BASES = "GTAC"
CHANNELS = ("ch_g", "ch_t", "ch_a", "ch_c")
N_GENES = 111
N_UNUSED = 5
N_CYCLES = 7
N_BARCODE = 15
TILE = 3200
CELLS_PER_TILE = 256
HEIGHT, WIDTH = 20, 25  # of a pixel frame
CELLS_PER_TASK = 5_000  # when their pixels are listed; a task holds all of them twice, and dealing by hash gives some tasks double


def _digit(number: str, place: int) -> str:
    return f"(({number}) // {4 ** place}) % 4"


_GENE_CODE = "((({g}) + 1) * 7919 % 16384)"
_BARCODE = "((({k}) + 1) * 2654435761 % 1073741824)"  # 15 base-4 digits


def _letters(number: str, n: int) -> str:
    return " || ".join(f"substr('{BASES}', CAST(1 + {_digit(number, p)} AS INT), 1)" for p in range(n))


def _weight(place: str) -> str:
    """4 to the given power as a whole number."""
    return f"CAST(pow(4, {place}) AS BIGINT)"


def _cycle_digit(number: str, cycle: str = "cycle") -> str:
    return f"(({number}) // {_weight(f'{N_BARCODE} - {cycle}')} % 4)"


def _spelled(columns: str, number: str, place: str, source: str) -> str:
    """Barcode text of a number whose digit at a 0-based place, if there is one, is raised by 1."""
    raised = "(bc // w % 4 + 1) % 4 - bc // w % 4"
    return f"""
        SELECT {columns}, translate(base4(bc + CASE WHEN place < {N_BARCODE} THEN ({raised}) * w ELSE 0 END), '0123', '1234') AS seq
        FROM (SELECT *, {_weight(f'CASE WHEN place < {N_BARCODE} THEN {N_BARCODE - 1} - place ELSE 0 END')} AS w
              FROM (SELECT *, {_BARCODE.format(k=number)} AS bc, {place} AS place FROM {source}) b) p"""


_PIXEL = (
    f"CAST(k // {HEIGHT * WIDTH} AS INT) AS fov, CAST(k % {HEIGHT * WIDTH} // {WIDTH} AS INT) AS r, "
    f"CAST(k % {WIDTH} AS INT) AS c"
)
_CENT_R = f"(({{k}}) * 7919) % 3203 % {TILE}"
_CENT_C = f"(({{k}}) * 104729) % 3209 % {TILE}"

INPUTS: dict[str, str] = {
    # ---- tiles, cells, spots -------------------------------------------------
    "fx_cells": f"""
        SELECT CAST(o_orderkey // {CELLS_PER_TILE} AS INT) AS fov,
               CAST(o_orderkey % {CELLS_PER_TILE} + 1 AS BIGINT) AS cell_num,
               CAST({_CENT_R.format(k='o_orderkey')} AS DOUBLE) AS cent_x,
               CAST({_CENT_C.format(k='o_orderkey')} AS DOUBLE) AS cent_y
        FROM orders""",
    "fx_tforms": """
        SELECT fov, CAST(fov // 16 + 1 AS INT) AS slice,
               CAST(0.5 AS DOUBLE) AS scale,
               CAST(((fov % 16) // 4) * 1232 AS DOUBLE) AS pos_x,
               CAST((fov % 4) * 1232 AS DOUBLE) AS pos_y
        FROM (SELECT DISTINCT fov FROM fx_cells) t""",
    "fx_tiles": """
        SELECT fov,
               'MAX_Pos' || CAST(fov // 16 + 1 AS STRING) || '_' ||
               lpad(CAST((fov % 16) // 4 AS STRING), 3, '0') || '_' ||
               lpad(CAST(fov % 4 AS STRING), 3, '0') AS tile_name,
               'Pos' || CAST(fov // 16 + 1 AS STRING) AS position
        FROM (SELECT DISTINCT fov FROM fx_cells) t""",
    "fx_spots": f"""
        SELECT CASE WHEN l_linenumber = 7 THEN 'hyb' ELSE 'geneseq' END AS modality,
               CAST(l_orderkey // {CELLS_PER_TILE} AS INT) AS fov,
               CAST(CASE WHEN l_linenumber = 7 THEN l_partkey % 3 ELSE l_partkey % {N_GENES} END AS INT) AS gene_id,
               {_CENT_R.format(k='l_orderkey')} + (l_partkey * 31 + l_linenumber * 7) % 11 - 5
                 + CAST(l_suppkey % 4 AS DOUBLE) / 4 AS lroi_x,
               {_CENT_C.format(k='l_orderkey')} + (l_suppkey * 17 + l_linenumber * 5) % 11 - 5
                 + CAST(l_partkey % 4 AS DOUBLE) / 4 AS lroi_y,
               l_extendedprice AS signal,
               ((l_orderkey * 8 + l_linenumber) * 200003 + l_partkey) * 1009 + l_suppkey AS spot_id
        FROM lineitem""",
    "fx_mask": f"""
        SELECT fov, r, c, min(cell_num) AS label FROM (
          SELECT fov, cell_num, CAST(cent_x AS INT) + dr AS r, CAST(cent_y AS INT) + dc AS c FROM (
            SELECT fov, cell_num, cent_x, cent_y, dr, each(-4, 4) AS dc FROM (
              SELECT fov, cell_num, cent_x, cent_y, each(-4, 4) AS dr FROM fx_cells) a1) a2) b
        WHERE r >= 0 AND r < {TILE} AND c >= 0 AND c < {TILE}
        GROUP BY fov, r, c""",
    # ---- codebooks -----------------------------------------------------------
    "fx_codebook": f"""
        SELECT CAST(p_partkey % {N_GENES} AS INT) AS gene_id,
               CASE WHEN p_partkey % {N_GENES} >= {N_GENES - N_UNUSED}
                    THEN 'unused-' || CAST(p_partkey % {N_GENES} - {N_GENES - N_UNUSED - 1} AS STRING)
                    ELSE 'Gene' || CAST(p_partkey % {N_GENES} AS STRING) END AS gene,
               {_letters(_GENE_CODE.format(g=f'p_partkey % {N_GENES}'), N_CYCLES)} AS sequence
        FROM part GROUP BY p_partkey % {N_GENES}""",
    "fx_hyb_codebook": """
        SELECT CAST(s_suppkey % 3 AS INT) AS gene_id,
               'Hyb' || CAST(s_suppkey % 3 AS STRING) AS gene,
               CAST(CASE WHEN s_suppkey % 3 = 2 THEN 4 ELSE s_suppkey % 3 + 1 END AS STRING) AS sequence
        FROM supplier GROUP BY s_suppkey % 3""",
    "fx_opt_codebook": f"""
        SELECT CAST(p_size % 7 AS INT) AS gene_id, 'Opt' || CAST(p_size % 7 AS STRING) AS gene,
               {_letters(_GENE_CODE.format(g='500 + p_size % 7'), N_CYCLES)} AS sequence
        FROM part GROUP BY p_size % 7""",
    # ---- pixels --------------------------------------------------------------
    # One order is one pixel; a frame of HEIGHT x WIDTH divides the table, so every frame is full.
    "fx_px": f"""
        SELECT fov, cycle, r, c,
               {', '.join(
                   f"CAST((custkey * 37 + r * r * 13 + c * 7 + {ch * 101} + r * c * 3 + cycle * 17) % 31 + "
                   f"CASE WHEN base = {ch} THEN amp ELSE 0 END AS INT) AS {CHANNELS[ch]}" for ch in range(4))}
        FROM (
          SELECT fov, cycle, r, c, custkey, amp,
                 {_GENE_CODE.format(g='gene')} // {_weight('cycle - 1')} % 4 AS base
          FROM (
            SELECT {_PIXEL}, custkey, custkey % {N_GENES - N_UNUSED} AS gene,
                   CASE WHEN (k // {WIDTH} * 7 + k % {WIDTH} * 3 + k // {HEIGHT * WIDTH}) % 11 = 0
                        THEN 140 + (custkey * 13) % 60 ELSE 0 END AS amp,
                   each(1, {N_CYCLES}) AS cycle
            FROM (SELECT o_orderkey AS k, o_custkey AS custkey FROM orders) o) p) q""",
    # Images of the hybridisation cycle, one customer a pixel: broad spots with flat tops.
    "fx_hyb_px": f"""
        SELECT fov, CAST(1 AS INT) AS cycle, r, c,
               {', '.join(
                   f"CAST((r * 5 + c * 11 + fov * 3 + {ch * 17}) % 23 + CASE WHEN (r // 3 * 5 + c // 4 * 3 + fov) % 7 = {ch} "
                   f"THEN 60 + 20 * ((r + c * 2 + fov) % 3) ELSE 0 END AS INT) AS {CHANNELS[ch]}" for ch in range(4))}
        FROM (SELECT {_PIXEL} FROM (SELECT c_custkey AS k FROM customer) o) p""",
    "fx_mask_px": f"""
        SELECT fov, r, c, CAST(r // 5 * 5 + c // 5 + 1 AS BIGINT) AS label
        FROM (SELECT {_PIXEL} FROM (SELECT o_orderkey AS k FROM orders) o) p
        WHERE r % 5 BETWEEN 1 AND 4 AND c % 5 BETWEEN 0 AND 3""",
    "fx_mask_nuc": f"""
        SELECT fov, r, c, CAST(r // 10 * 3 + c // 10 + 1 AS BIGINT) AS label
        FROM (SELECT {_PIXEL} FROM (SELECT o_orderkey AS k FROM orders) o) p
        WHERE r % 10 BETWEEN 2 AND 7 AND c % 10 BETWEEN 3 AND 8""",
    # Summed channels of every cycle, moved by a shift that differs by tile and cycle.
    "fx_moving": f"""
        SELECT fov, cycle, r + (fov + cycle) % 5 - 2 AS r, c + (fov * 2 + cycle) % 5 - 2 AS c,
               CAST(ch_g + ch_t + ch_a + ch_c AS DOUBLE) AS v
        FROM fx_px WHERE r + (fov + cycle) % 5 - 2 BETWEEN 0 AND {HEIGHT - 1}
                     AND c + (fov * 2 + cycle) % 5 - 2 BETWEEN 0 AND {WIDTH - 1}""",
    "fx_flat": f"""
        SELECT r, c, CAST(3 + (r + c) % 4 AS DOUBLE) AS dark, CAST(4 + (r * 3 + c) % 3 AS DOUBLE) / 4 AS flat
        FROM (SELECT {_PIXEL} FROM (SELECT o_orderkey AS k FROM orders) o) p GROUP BY r, c""",
    # ---- barcodes ------------------------------------------------------------
    # Positions p with (l_partkey + 3p) % 37 = 0 carry an error: at most one of the 15.
    "fx_bc_spots": _spelled(
        f"l_orderkey // {CELLS_PER_TILE} * 10000 + l_orderkey % {CELLS_PER_TILE} + 1 AS cell_id, "
        "((l_orderkey * 8 + l_linenumber) * 200003 + l_partkey) * 1009 + l_suppkey AS spot_id",
        "l_orderkey", "(37 - l_partkey % 37) * 25 % 37", "lineitem"),
    "fx_bc_signal": f"""
        SELECT spot_id, fov, cycle,
               {', '.join(f"CASE WHEN part % 29 = cycle THEN 0 ELSE 20 + (okey * 31 + part * 7 + cycle * 13 + {ch * 101}) % 61 "
                          f"+ CASE WHEN base = {ch} THEN 120 ELSE 0 END END AS s{ch + 1}" for ch in range(4))}
        FROM (
          SELECT spot_id, fov, okey, part, cycle, {_cycle_digit(_BARCODE.format(k='okey'))} AS base
          FROM (
            SELECT ((l_orderkey * 8 + l_linenumber) * 200003 + l_partkey) * 1009 + l_suppkey AS spot_id,
                   CAST(l_orderkey // {CELLS_PER_TILE} AS INT) AS fov, l_orderkey AS okey, l_partkey AS part,
                   each(1, {N_BARCODE}) AS cycle
            FROM lineitem) a) b""",
    "fx_soma_cycles": f"""
        SELECT cell_id, cycle, {_cycle_digit(_BARCODE.format(k='okey'))} + 1 AS base,
               CAST(80 + (okey * 7 + cycle * 13) % 20 AS DOUBLE) / 100 AS score,
               CAST(120 + (custkey * 11 + cycle * 29) % 160 AS DOUBLE) AS peak
        FROM (SELECT o_orderkey // {CELLS_PER_TILE} * 10000 + o_orderkey % {CELLS_PER_TILE} + 1 AS cell_id,
                     each(1, {N_BARCODE}) AS cycle, o_orderkey AS okey, o_custkey AS custkey
              FROM orders WHERE o_orderstatus <> 'P') s""",
    # Positions p with (c_custkey + 2p) % 31 = 0 differ from the cell barcode of the same number.
    "fx_library": _spelled("c_custkey", "c_custkey * 7", "(31 - c_custkey % 31) * 16 % 31", "customer"),
    "fx_library_counts": """
        SELECT c_custkey AS barcode_id, seq AS sequence, area_id,
               CASE WHEN (c_custkey * 5 + area_id * 3) % 4 = 0 AND c_custkey % 6 <> 0 THEN (c_custkey + area_id) % 9 + 1 ELSE 0 END AS n
        FROM (SELECT c_custkey, seq, each(0, 7) AS area_id FROM fx_library) l""",
    # ---- matches and points ----------------------------------------------------
    "fx_matches": f"""
        SELECT o_orderkey // {CELLS_PER_TILE} * 10000 + o_orderkey % {CELLS_PER_TILE} + 1 AS cell_id, o_custkey AS sunit_id FROM orders""",
    "fx_units": """
        SELECT c_custkey AS sunit_id, c_custkey * 10 + k AS unit_id, CAST(c_nationkey % 4 + 1 AS INT) AS scan_idx,
               CAST(c_nationkey % 2 AS INT) AS stack_idx
        FROM (SELECT c_custkey, c_nationkey, each(1, 3) AS k FROM customer) u WHERE k <= c_custkey % 4""",
    "fx_points": """
        SELECT c_custkey AS sunit_id, CAST(c_nationkey % 2 AS INT) AS stack_idx,
               CAST((c_custkey * 37) % 1009 AS DOUBLE) / 4 AS sunit_x, CAST((c_custkey * 53) % 1013 AS DOUBLE) / 4 AS sunit_y,
               CAST((c_custkey * 11) % 211 AS DOUBLE) AS sunit_z, CAST((c_custkey * 3) % 97 AS DOUBLE) AS depth
        FROM customer""",
    "fx_regions": """
        SELECT s_suppkey AS region, CAST(s_suppkey * 100 AS DOUBLE) AS x, CAST(s_nationkey * 50 AS DOUBLE) AS y,
               CAST(s_suppkey % 7 AS DOUBLE) AS z
        FROM supplier""",
    "fx_offsets": """
        SELECT a.slice, a.fov AS tile_a, b.fov AS tile_b, b.px - a.px AS dx, b.py - a.py AS dy
        FROM (SELECT *, pos_x + (fov * 7) % 11 * CAST(0.25 AS DOUBLE) AS px, pos_y + (fov * 5) % 13 * CAST(0.25 AS DOUBLE) AS py FROM fx_tforms) a
        JOIN (SELECT *, pos_x + (fov * 7) % 11 * CAST(0.25 AS DOUBLE) AS px, pos_y + (fov * 5) % 13 * CAST(0.25 AS DOUBLE) AS py FROM fx_tforms) b
        ON a.slice = b.slice AND (b.fov = a.fov + 4 OR (b.fov = a.fov + 1 AND a.fov % 4 < 3))""",
    # ---- files ---------------------------------------------------------------
    "fx_files": f"""
        SELECT CASE WHEN slot <= 7 THEN 'geneseq0' || CAST(slot AS STRING)
                    WHEN slot = 8 THEN 'hyb01' WHEN slot = 9 THEN 'bcseq01' ELSE 'thumbs' END || '/' ||
               CASE WHEN custkey % 50 = 0 THEN 'tmp_' || CAST(tile AS STRING)
                    ELSE 'MAX_Pos' || CAST(tile // 16 + 1 AS STRING) || '_' || lpad(CAST(tile % 16 // 4 AS STRING), 3, '0')
                         || '_' || lpad(CAST(tile % 4 AS STRING), 3, '0') END ||
               CASE WHEN slot = 8 THEN '.denoised.v2' ELSE '' END || '.tif' AS path
        FROM (SELECT o_orderkey // 10 AS tile, o_orderkey % 10 + 1 AS slot, o_custkey AS custkey FROM orders) f""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in INPUTS if re.search(rf"\b{name}\b", sql)]


@cache
def _closure(names: tuple[str, ...]) -> tuple[str, ...]:
    done: list[str] = []
    for name in names:
        for inner in _closure(tuple(_needs(INPUTS[name]))):
            if inner not in done:
                done.append(inner)
        if name not in done:
            done.append(name)
    return tuple(done)


def _call(sql: str, name: str, body) -> str:
    """Replace every ``name(argument)``, the argument with balanced brackets, by ``body(argument)``."""
    while (at := sql.find(f"{name}(")) >= 0:
        depth, end = 1, at + len(name) + 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:at] + body(sql[at + len(name) + 1 : end - 1]) + sql[end:]
    return sql


def check_text(sql: str) -> str:
    """SQL for the checking database, with the inputs it names put before it."""
    out = re.sub(r"each\(([^,()]+), ([^,()]+)\)", r"CAST(unnest(range(\1, \2 + 1)) AS INT)", sql)
    out = out.replace("AS STRING", "AS VARCHAR")
    return _call(out, "base4", lambda x: f"to_base({x}, 4, {N_BARCODE})")


def oracle(sql: str) -> str:
    """Prefix ``sql`` with the inputs it refers to."""
    body = sql.strip()
    ctes = ",\n".join(f"{n} AS ({check_text(INPUTS[n])})" for n in _closure(tuple(_needs(body))))
    body = check_text(body)
    if not ctes:
        return body
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(head):
            return f"{head}{ctes},\n{body[len(head):]}"
    return f"WITH {ctes}\n{body}"


def spark_text(sql: str) -> str:
    out = re.sub(r"each\(([^,()]+), ([^,()]+)\)", r"explode(sequence(\1, \2))", sql)
    out = _call(out, "base4", lambda x: f"lpad(conv(CAST({x} AS STRING), 10, 4), {N_BARCODE}, '0')")
    return out.replace("//", " div ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one that is a single small file is spread over the cores,
    because the inputs turn each of its rows into many.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def mask_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions into which the mask is dealt by tile, by the number of its cells; the file says how many there are."""
    return parts_of_cells(spark, spark.read.parquet(f"{sf_dir}/orders.parquet").count())


def parts_of_cells(spark: SparkSession, n_cells: int) -> int:
    """Partitions in which a task lists the pixels of ``CELLS_PER_TASK`` of so many cells."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_cells // CELLS_PER_TASK))


def load(spark: SparkSession, sf_dir: str, name: str, parts: int | None = None) -> DataFrame:
    """The derived input ``name`` as a DataFrame, made of sources dealt by tile into ``parts`` where that is given.

    Pixels of a tile then come together in one partition before they are listed, and never move.
    """
    sql = spark_text(INPUTS[name])
    sources = {n: load(spark, sf_dir, n) for n in _needs(INPUTS[name])}
    if parts is not None:
        sources = {n: df.repartition(parts, "fov") for n, df in sources.items()}
    sources |= {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\bFROM {t}\b", sql)}
    for source in sources:
        sql = re.sub(rf"\bFROM {source}\b", f"FROM {{{source}}}", sql)
    return spark.sql(sql, **sources)

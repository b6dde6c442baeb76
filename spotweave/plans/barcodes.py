"""Queries over cell barcodes and the barcode library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.functions.vectors import complexity_score, hamming, subword_usage
from spotweave.operators import assign, barcodes as bc
from spotweave.plans.inputs import N_BARCODE
from spotweave.plans.registry import Inputs, Registry, rounded

barcodes = Registry()
AREAS = tuple(f"area{i}" for i in range(8))  # library areas of the derived data

USAGE = [
    f"len(list_distinct(list_transform(range(1, {N_BARCODE - k + 2}), lambda p: substr(seq, p, {k})))) / CAST({min(4 ** k, N_BARCODE - k + 1)} AS DOUBLE)"
    for k in range(1, N_BARCODE + 1)
]
COMPLEXITY = f"log10({' * '.join(f'({u})' for u in USAGE)})"


@barcodes.query(
    f"""WITH u AS (SELECT DISTINCT seq FROM fx_bc_spots)
    SELECT seq, {', '.join(f'round({u}, 6) AS u{k}' for k, u in enumerate(USAGE, 1))} FROM u"""
)
def subword_usage_of_barcodes(i: Inputs) -> DataFrame:
    used = i.bc_spots.select("seq").distinct().withColumn("u", subword_usage("seq"))
    return rounded(used.select("seq", *[F.get("u", F.lit(k)).alias(f"u{k + 1}") for k in range(N_BARCODE)]))


@barcodes.query(f"WITH u AS (SELECT DISTINCT seq FROM fx_bc_spots) SELECT seq, round({COMPLEXITY}, 6) AS complexity FROM u")
def barcode_complexity(i: Inputs) -> DataFrame:
    return rounded(i.bc_spots.select("seq").distinct().withColumn("complexity", complexity_score("seq")))


@barcodes.query(
    """WITH top AS (SELECT cell_id, min(seq) AS lo FROM fx_bc_spots GROUP BY cell_id)
    SELECT s.spot_id, s.seq, hamming(s.seq, lo)::INT AS d FROM fx_bc_spots s JOIN top USING (cell_id)"""
)
def barcode_distance(i: Inputs) -> DataFrame:
    """Distance of every barcode from the lowest one of its cell."""
    low = i.bc_spots.groupBy("cell_id").agg(F.min("seq").alias("lo"))
    return i.bc_spots.join(low, "cell_id").select("spot_id", "seq", hamming("seq", "lo").alias("d"))


@barcodes.query("SELECT cell_id, seq, count(*) AS n FROM fx_bc_spots GROUP BY ALL")
def unique_barcodes(i: Inputs) -> DataFrame:
    return bc.unique_barcodes(i.bc_spots)


def collapsed(source: str, errors: int) -> str:
    """Step the barcodes of every cell one by one, keeping the accepted ones in lists."""
    return f"""
    u AS (SELECT cell_id, seq, n, row_number() OVER (PARTITION BY cell_id ORDER BY n DESC, seq) AS k
      FROM (SELECT cell_id, seq, count(*) AS n FROM {source} GROUP BY ALL) q),
    st AS (
      SELECT cell_id, 1::BIGINT AS k, [seq] AS owners, [n] AS ns FROM u WHERE k = 1
      UNION ALL
      SELECT cell_id, k, CASE WHEN best <= {errors} THEN owners ELSE list_append(owners, seq) END,
        CASE WHEN best <= {errors} THEN list_transform(ns, lambda x, j: x + CASE WHEN j = place THEN n ELSE 0 END) ELSE list_append(ns, n) END
      FROM (SELECT *, list_min(d) AS best, list_position(d, list_min(d)) AS place FROM (
        SELECT st.cell_id, u.k, owners, ns, u.seq, u.n, list_transform(owners, lambda o: hamming(o, u.seq)) AS d
        FROM st JOIN u ON u.cell_id = st.cell_id AND u.k = st.k + 1) a) b),
    merged AS (SELECT cell_id, unnest(owners) AS seq, unnest(ns) AS n, unnest(range(len(owners))) AS rank
      FROM (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY k DESC) = 1) f)"""


@barcodes.query(f"WITH RECURSIVE {collapsed('fx_bc_spots', 2)} SELECT cell_id, seq, n FROM merged")
def collapsed_barcodes(i: Inputs) -> DataFrame:
    return bc.collapse_barcodes(i.bc_spots, errors=2)


@barcodes.query(f"WITH RECURSIVE {collapsed('fx_bc_spots', 1)} SELECT cell_id, seq, n FROM merged")
def collapsed_barcodes_in_rounds(i: Inputs) -> DataFrame:
    """The same collapse with one error allowed."""
    return bc.collapse_barcodes(i.bc_spots, errors=1)


SOMA = f"""
    soma AS (SELECT cell_id, string_agg(CAST(base AS VARCHAR), '' ORDER BY cycle) AS seq, list_sort(list(score)) AS score, list_sort(list(peak)) AS peak
      FROM fx_soma_cycles GROUP BY cell_id),
    cell AS (SELECT cell_num + CAST(fov AS BIGINT) * 10000 AS cell_id FROM fx_cells),
    att AS (SELECT c.cell_id, coalesce(seq, '{'0' * N_BARCODE}') AS seq, coalesce(score[3], 0) AS score3, coalesce(peak[3], 0) AS peak3, seq IS NULL AS missing
      FROM cell c LEFT JOIN soma s USING (cell_id))"""


def attached(i: Inputs) -> DataFrame:
    cells = i.cells.select(assign.global_cell_id().alias("cell_id"))
    return bc.attach_soma_barcodes(cells, bc.soma_table(i.soma_cycles), N_BARCODE)


@barcodes.query(f"WITH {SOMA} SELECT cell_id, seq, missing FROM att")
def soma_barcodes(i: Inputs) -> DataFrame:
    return attached(i).select("cell_id", "seq", "missing")


@barcodes.query(
    f"""WITH {SOMA} SELECT cell_id, missing, {COMPLEXITY} >= -0.9 AND score3 >= 0.81 AND peak3 >= 140 AS is_barcoded FROM att"""
)
def barcoded_cells(i: Inputs) -> DataFrame:
    return attached(i).select("cell_id", "missing", bc.is_barcoded(-0.9, 0.81, 140).alias("is_barcoded"))


@barcodes.query(
    f"""WITH RECURSIVE enough AS (SELECT * FROM fx_bc_spots WHERE cell_id IN (SELECT cell_id FROM fx_bc_spots GROUP BY cell_id HAVING count(*) > 3)),
    {collapsed('enough', 2)},
    top AS (SELECT cell_id, max(n) AS best FROM merged GROUP BY cell_id HAVING max(n) > 3)
    SELECT m.cell_id, m.seq, m.n, m.rank = min(CASE WHEN m.n = t.best THEN m.rank END) OVER (PARTITION BY m.cell_id) AS dominant
    FROM merged m JOIN top t USING (cell_id)"""
)
def dominant_barcodes(i: Inputs) -> DataFrame:
    return bc.dominant_barcode(i.bc_spots)


@barcodes.query(f"WITH {SOMA} SELECT cell_id, seq, 1::BIGINT AS n, TRUE AS dominant FROM att")
def dominant_soma_barcodes(i: Inputs) -> DataFrame:
    return bc.dominant_soma_barcode(attached(i))


NAMES = "[" + ", ".join(f"'{a}'" for a in AREAS) + "]"


@barcodes.query(
    f"""SELECT barcode_id, sequence, '[' || string_agg('''' || {NAMES}[area_id + 1] || '''', ', ' ORDER BY area_id) || ']' AS target_areas,
      '[' || string_agg(CAST(area_id AS VARCHAR), ', ' ORDER BY area_id) || ']' AS target_area_ids,
      '[' || string_agg(CAST(n AS VARCHAR), ', ' ORDER BY area_id) || ']' AS target_counts
    FROM fx_library_counts WHERE n > 0 GROUP BY barcode_id, sequence"""
)
def library_summary(i: Inputs) -> DataFrame:
    return bc.library_summary(i.library_counts, AREAS, N_BARCODE)


@barcodes.query(
    f"""SELECT barcode_id, string_agg({NAMES}[area_id + 1], ',' ORDER BY area_id) AS target_areas,
      string_agg(CAST(n AS VARCHAR), ',' ORDER BY area_id) AS target_counts
    FROM fx_library_counts WHERE n > 0 GROUP BY barcode_id"""
)
def cleaned_library(i: Inputs) -> DataFrame:
    listed = bc.library_summary(i.library_counts, AREAS, N_BARCODE)
    return listed.select(
        "barcode_id", bc.clean_list("target_areas").alias("target_areas"), bc.clean_list("target_counts").alias("target_counts")
    )


@barcodes.query(
    """WITH lib AS MATERIALIZED (SELECT DISTINCT barcode_id, sequence FROM fx_library_counts WHERE n > 0),
    s AS MATERIALIZED (SELECT DISTINCT seq FROM fx_bc_spots),
    m AS (SELECT seq, max(barcode_id) AS barcode_id FROM s JOIN lib ON hamming(seq, sequence) <= 1 GROUP BY seq)
    SELECT spot_id, cell_id, seq, barcode_id FROM fx_bc_spots JOIN m USING (seq)"""
)
def projection_matches(i: Inputs) -> DataFrame:
    library = i.library_counts.where("n > 0").select("barcode_id", "sequence").distinct()
    return bc.match_library(i.bc_spots.select("spot_id", "cell_id", "seq"), library, N_BARCODE)


@barcodes.query(
    """SELECT m.cell_id, m.sunit_id, u.unit_id, u.scan_idx FROM fx_matches m LEFT JOIN fx_units u USING (sunit_id)"""
)
def expanded_matches(i: Inputs) -> DataFrame:
    cells = i.cells.select(assign.global_cell_id().alias("cell_id"))
    return bc.expand_matches(cells, i.matches, i.units.select("sunit_id", "unit_id", "scan_idx"))


@barcodes.query(
    """SELECT m.cell_id, c.cent_y AS x1, c.cent_x AS y1, CAST(c.fov AS DOUBLE) AS z1, m.sunit_id, p.sunit_x AS x2, p.sunit_y AS y2, p.sunit_z AS z2
    FROM fx_matches m JOIN fx_cells c ON c.cell_num + CAST(c.fov AS BIGINT) * 10000 = m.cell_id JOIN fx_points p USING (sunit_id)"""
)
def matched_centroids(i: Inputs) -> DataFrame:
    cells = i.cells.select(
        assign.global_cell_id().alias("cell_id"), F.col("cent_y").alias("x"), F.col("cent_x").alias("y"), F.col("fov").cast("double").alias("z")
    )
    points = i.points.select("sunit_id", F.col("sunit_x").alias("x"), F.col("sunit_y").alias("y"), F.col("sunit_z").alias("z"))
    return bc.matched_centroids(i.matches, cells, points)

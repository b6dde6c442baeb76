"""Tile placement along the heaviest links."""

import random

import pytest

from spotweave.operators import layout

LINK = "slice int, tile_a int, tile_b int, dx double, dy double, weight double"


def kruskal(links):
    """Positions seen from the lowest tile of each part."""
    at = {t: {t: (0.0, 0.0)} for a, b, *_ in links for t in (a, b)}
    ways = [(-w, a, b, dx, dy) if a < b else (-w, b, a, -dx, -dy) for a, b, dx, dy, w in links if a != b]
    for _, a, b, dx, dy in sorted(ways):
        if at[a] is not at[b]:
            (xa, ya), (xb, yb) = at[a][a], at[b][b]
            for tile, (x, y) in list(at[b].items()):
                at[a][tile] = (x + xa + dx - xb, y + ya + dy - yb)
                at[tile] = at[a]
    out = {}
    for part in {id(p): p for p in at.values()}.values():
        low = [min(p[k] for p in part.values()) for k in (0, 1)]
        out |= {t: (min(part), x - low[0], y - low[1]) for t, (x, y) in part.items()}
    return out


def placed(spark, rows, schema=LINK):
    return {(r.slice, r.tile): (r.part, r.pos_x, r.pos_y) for r in layout.place_tiles(spark.createDataFrame(rows, schema)).collect()}


def test_placement_against_a_spanning_tree(spark):
    rng = random.Random(2)
    want, rows = {}, []
    for s in range(3):
        links = [(rng.randrange(25), rng.randrange(25), rng.randrange(-40, 40) / 4, rng.randrange(-40, 40) / 4, rng.randrange(4) / 4) for _ in range(22 + 20 * s)]
        want |= {(s, t): p for t, p in kruskal(links).items()}
        rows += [(s, *x) for x in links]
    assert placed(spark, rows) == want


def test_long_strip_takes_few_rounds(spark, monkeypatch):
    written = []
    real = layout.settle
    monkeypatch.setattr(layout, "settle", lambda df, label: written.append(label) or real(df, label))
    n = 2_000
    order = random.Random(4).sample(range(n), n)  # numbers say nothing of the place in the strip
    got = placed(spark, [(0, order[k], order[k + 1], 3.0, -1.0, float(k % 7)) for k in range(n - 1)])
    assert got == {(0, t): (0, 3.0 * k, float(n - 1 - k)) for k, t in enumerate(order)}
    assert written.count("links") <= 12 and len(written) < 60


def test_odd_links(spark):
    rows = [(0, 1, 2, 5.0, 1.0, None), (0, 2, 1, -9.0, 0.0, 0.1), (0, 3, 3, 1.0, 1.0, 1.0), (0, 4, 5, None, 1.0, 1.0), (0, 1, 2, 9.0, 0.0, 0.1)]
    assert placed(spark, rows) == {(0, 1): (1, 0.0, 0.0), (0, 2): (1, 9.0, 0.0)} | {(0, t): (t, 0.0, 0.0) for t in (3, 4, 5)}
    assert placed(spark, []) == {}


@pytest.mark.parametrize("schema", [LINK.rsplit(",", 1)[0]])
def test_links_without_weight(spark, schema):
    assert placed(spark, [(0, 0, 1, 4.0, 0.0), (0, 1, 2, 0.0, 2.0), (0, 0, 2, 9.0, 9.0)], schema)[(0, 2)] == (0, 9.0, 9.0)

"""Clusters by the sparse certificate against all pairs."""

import random

import pytest

from strandline.operators import sv_cells, variants

SCHEMA = "cnv_id string, chromosome string, type string, start long, end long"


def plain(rows, t):
    """Components of all pairs, smallest id each."""
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ok = [r for r in rows if None not in r and r[4] > r[3]]
    for i, (a, ca, ta, sa, ea) in enumerate(ok):
        for b, cb, tb, sb, eb in ok[i + 1:]:
            if (ca, ta) == (cb, tb):
                ov = min(ea, eb) - max(sa, sb)
                if min(ov / (ea - sa), ov / (eb - sb)) >= t:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {r[0]: find(r[0]) for r in rows}


def clustered(spark, rows, t):
    out = variants.sv_clusters(spark.createDataFrame(rows, SCHEMA), t).collect()
    assert len(out) == len(rows)
    return {r["cnv_id"]: r["cluster_id"] for r in out}


@pytest.mark.parametrize("t,reach,longest", [(0.8, 400, 900), (0.5, 3000, 5000), (0.95, 100, 2000), (1.0, 20, 12)])
def test_clusters_equal_all_pairs(spark, t, reach, longest):
    rnd = random.Random(4)
    rows = []
    for i in range(260):
        s = rnd.randint(0, reach)
        rows.append((f"v{i:04}", rnd.choice(["c1", "c2"]), rnd.choice(["DEL", "DUP"]), s, s + rnd.randint(1, longest)))
    rows += [("x1", None, "DEL", 0, 9), ("x2", None, "DEL", 0, 9), ("x3", "c1", "DEL", 5, 5), ("x4", "c1", "DEL", 5, 5),
             ("x5", "c1", "DEL", 9, 3), ("x6", "c1", None, 1, 2), ("x7", "c1", "DEL", None, 2)]
    assert clustered(spark, rows, t) == plain(rows, t)
    assert clustered(spark, [], t) == {}


def test_cells_in_doubt_are_refined(spark, monkeypatch):
    """Long intervals: many members a cell, and borders that run through cells."""
    rnd = random.Random(9)
    rows, seen = [], []
    for i in range(300):
        s, n = rnd.randint(0, 60_000), rnd.randint(90_000, 160_000)
        rows.append((f"v{i:04}", "c", "DEL", s, s + n))
    finer = sv_cells.boxes
    monkeypatch.setattr(sv_cells, "boxes", lambda df, keys: seen.append(keys) or finer(df, keys))
    for t in (0.8, 0.9, 0.97):
        assert clustered(spark, rows, t) == plain(rows, t)
    assert sum("sub" in k for k in seen) >= 2


def test_near_identical_variants_make_no_pairs(spark):
    """10,000 variants at one site: cells and their links stay few."""
    rnd = random.Random(2)
    rows = [(f"v{i:05}", "c", "DEL", 10 ** 6 + rnd.randint(0, 300), 10 ** 6 + 20_000 + rnd.randint(0, 300))
            for i in range(10_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    cells = sv_cells.boxes(df.select("*", *sv_cells.cell_key(0.8)), ["chromosome", "type", "power", "width", "c_start", "c_end"])
    assert cells.count() <= 9
    assert set(clustered(spark, rows, 0.8).values()) == {"v00000"}


def test_pairs_from_lists_of_a_site_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(variants, "PAIR_BLOCK", 2)  # sites of several lists
    rnd = random.Random(9)
    rows = [(f"v{i:02}", rnd.choice(["c1", None]), "DEL", s, s + 100) for i in range(40) for s in [rnd.choice([0, 0, 0, 10, 15, 30])]]
    rows += [("v03", "c1", "DEL", 0, 100), (None, "c1", "DEL", 0, 100), ("w", "c1", "DEL", 5, 5)]
    ok = [r for r in rows if None not in r and r[4] > r[3]]
    want = sorted((a[0], a[3], b[0], b[3]) for a in ok for b in ok if a[0] < b[0] and a[1] == b[1] and 100 - abs(a[3] - b[3]) >= 80)
    got = variants.sv_pairs(spark.createDataFrame(rows, SCHEMA)).select("a_id", "a_start", "b_id", "b_start").collect()
    assert sorted(map(tuple, got)) == want and len(want) > 50


def test_pairs_are_written_in_runs(spark, tmp_path):
    rnd = random.Random(3)
    ids = rnd.sample(range(10 ** 8), 900)
    rows = [(f"v{n}", "c", "DEL", 20 * (i % 3), 20 * (i % 3) + 400) for i, n in enumerate(ids)]
    df = variants.sv_pairs(spark.createDataFrame(rows, SCHEMA).repartition(8)).select("a_id", "b_id")
    df.write.parquet(f"{tmp_path}/pairs")
    size = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert spark.read.parquet(f"{tmp_path}/pairs").distinct().count() == 900 * 899 // 2
    assert size < 0.8 * 900 * 899 // 2

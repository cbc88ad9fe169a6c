"""Range join and connected components against brute force."""

import random

from pyspark.sql import functions as F

from strandline.operators import ranges


def test_overlap_join_matches_brute_force(spark):
    rnd = random.Random(7)
    left = [(i, f"c{rnd.randint(1, 2)}", s, s + rnd.randint(0, 50)) for i, s in
            ((i, rnd.randint(0, 500)) for i in range(300))]
    right = [(j, f"c{rnd.randint(1, 2)}", s, s + rnd.randint(0, 200)) for j, s in
             ((j, rnd.randint(0, 500)) for j in range(200))]
    l = spark.createDataFrame(left, "lid int, chromosome string, start int, end int")
    r = spark.createDataFrame(right, "rid int, chromosome string, r_start int, r_end int")
    got = {(x.lid, x.rid) for x in ranges.overlap_join(l, r, ["chromosome"], right_start="r_start",
                                                        right_end="r_end", bin_size=37).collect()}
    want = {(a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3]}
    assert got == want


def test_overlap_join_of_any_length(spark):
    rnd = random.Random(11)
    lengths = [0, 1, 30, 900, 1023, 1024, 8192, 70000, 10 ** 6, 10 ** 8, 10 ** 10]
    left = [(i, "c", s, s + rnd.choice(lengths)) for i, s in ((i, rnd.randint(-5000, 200000)) for i in range(150))]
    right = [(j, "c", s, s + rnd.choice(lengths)) for j, s in ((j, rnd.randint(-5000, 200000)) for j in range(150))]
    l = spark.createDataFrame([*left, (998, "c", None, 5), (999, None, 1, 5)], "lid int, chromosome string, start long, end long")
    r = spark.createDataFrame([*right, (998, "c", 5, None)], "rid int, chromosome string, r_start long, r_end long")
    want = {(a[0], b[0]) for a in left for b in right if a[2] <= b[3] and b[2] <= a[3]}
    short = spark.createDataFrame([(j, "c", s, s + 20) for j, _, s, _ in right], r.schema)
    for bin_size, other in ((16, r), (None, r), (None, short)):
        rows = [(x.lid, x.rid) for x in ranges.overlap_join(l, other, ["chromosome"], right_start="r_start",
                                                            right_end="r_end", bin_size=bin_size).collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == (want if other is r else
                             {(a[0], b[0]) for a in left for b in right if a[2] <= b[2] + 20 and b[2] <= a[3]})


def test_a_long_interval_takes_few_bins(spark):
    df = spark.createDataFrame([(0, 10 ** 8)], "start long, end long")
    short = spark.createDataFrame([(i, i + 500) for i in range(100)], "start long, end long")
    length = ranges._length("start", "end")
    ladder = ranges._Ladder.of(df, length, short, length)
    assert ranges._binned(df, "start", "end", ladder, "_l").count() <= ranges.SPAN + 1


def test_heavy_bins_are_split_and_give_the_same_pairs(spark, monkeypatch):
    """A bin with a third of all rows on either side is dealt over several join keys."""
    monkeypatch.setattr(ranges, "HEAVY_ROWS", 200)
    monkeypatch.setattr(ranges, "HEAVY_SAMPLE", 1)
    rnd = random.Random(5)
    spots = [1000 + rnd.randint(0, 9) if rnd.random() < 0.4 else rnd.randint(0, 10 ** 6) for _ in range(2000)]
    left = [(i, "c", s, s + rnd.randint(0, 9) + (10 ** 5 if i % 500 == 0 else 0)) for i, s in enumerate(spots)]
    right = [(i, "c", s, s + 9) for i, s in enumerate(reversed(spots))]
    l = spark.createDataFrame(left, "lid int, chromosome string, start int, end int")
    r = spark.createDataFrame(right, "rid int, chromosome string, r_start int, r_end int")
    joined = ranges.overlap_join(l, r, ["chromosome"], right_start="r_start", right_end="r_end")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "_part_l" in plan and "_part_r" in plan
    got = [(x.lid, x.rid) for x in joined.collect()]
    want = {(a[0], b[0]) for a in left for b in right if a[2] <= b[3] and b[2] <= a[3]}
    assert len(got) == len(set(got)) and set(got) == want
    ladder = ranges._Ladder.of(l, ranges._length("start", "end"), r, ranges._length("r_start", "r_end"))
    binned = ranges._binned(l, "start", "end", ladder, "_l")
    heavy = ranges.heavy_bins(binned, ["chromosome"], "_l", 2000)
    shares = ranges._split(binned, heavy.withColumn("_parts_r", F.lit(2)), ["chromosome"], "_l")
    key = ["_level_l", "_side_l", "_bin_l", "_part_l_l", "_part_r_l"]
    assert shares.groupBy(*key).count().agg(F.max("count")).first()[0] < 0.5 * binned.groupBy(*key[:3]).count().agg(
        F.max("count")).first()[0]


def test_connected_components_matches_union_find(spark, monkeypatch):
    rnd = random.Random(3)
    n = 400
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(300)] + [(i, i + 1) for i in range(100, 180)]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for x in range(n):
        comp.setdefault(find(x), []).append(x)
    want = {x: min(members) for members in comp.values() for x in members}
    e = spark.createDataFrame(edges, "src long, dst long")
    nodes = spark.range(n).select(F.col("id"))
    got = {r.node: r.component for r in ranges.connected_components(e, nodes=nodes).collect()}
    assert got == want
    for edges_a_task in (40, 5):  # several tasks and rounds; then so few that the star rounds take over
        monkeypatch.setattr(ranges, "EDGES_A_TASK", edges_a_task)
        for near in ([], ["src"]):
            got = {r.node: r.component for r in ranges.connected_components(e, nodes=nodes, near=near).collect()}
            assert got == want
    text = e.select(*[F.concat(F.lit("n"), F.lpad(F.col(c).cast("string"), 4, "0")).alias(c) for c in ("src", "dst")])
    got = {int(r.node[1:]): int(r.component[1:]) for r in ranges.connected_components(text, near=["src"]).collect()}
    assert got == {x: c for x, c in want.items() if any(x in pair and pair[0] != pair[1] for pair in edges)}

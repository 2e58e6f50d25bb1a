"""Operators without an SQL oracle, null polarity and edge cases, against plain Python."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varloom.functions import numeric, special, variants
from varloom.operators import aggregates, corrections, graph, inference, intervals, joins, ledger, models, ranges, scans, sets_of, windows
from varloom.sources import delimited, genomic, sinks, vcf


def test_tails_round_trip():
    z = np.array([0.001, 0.5, 1.0, 5.0, 24.9, 25.0, 38.0, 100.0, 1000.0])
    assert np.allclose(special.z_of_ln_sf(special.ln_sf(z)), z, rtol=1e-11)
    assert special.ln_sf(np.array([1.0]))[0] == pytest.approx(math.log(math.erfc(1 / math.sqrt(2)) / 2))


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 60), st.data())
def test_hypergeometric(population, data):
    marked, drawn = data.draw(st.integers(0, population)), data.draw(st.integers(0, population))
    k = data.draw(st.integers(0, population))
    exact = sum(math.comb(marked, i) * math.comb(population - marked, drawn - i) for i in range(k, min(marked, drawn) + 1) if drawn - i >= 0) / math.comb(population, drawn)
    assert math.exp(special.ln_hypergeometric(k, population, marked, drawn)) == pytest.approx(exact, abs=1e-12)


def test_expressions(spark):
    d = spark.createDataFrame([("chr01", "12.0", "ac", "gt"), (" 23 ", "x", None, ""), (None, None, "A", "T")], "c string, p string, a string, b string")
    got = d.select(variants.canonical_chromosome(F.col("c")).alias("c"), variants.integral_position(F.col("p")).alias("p"), variants.allele(F.col("a")).alias("a"), variants.allele(F.col("b")).alias("b"), variants.palindromic(F.col("a"), F.col("b")).alias("pal"), variants.reverse_complement(variants.allele(F.col("a"))).alias("rc")).collect()
    assert [tuple(r) for r in got] == [("1", 12, "AC", "GT", False, "GT"), ("X", None, None, None, False, None), (None, None, "A", "T", True, "T")]


def test_minimal_alleles(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(1, 99), "".join(rnd.choices("AC", k=rnd.randint(1, 7))), "".join(rnd.choices("AC", k=rnd.randint(1, 7)))) for i in range(300)]

    def plain(p, a, b):
        while len(a) > 1 and len(b) > 1 and a[-1] == b[-1]:
            a, b = a[:-1], b[:-1]
        while len(a) > 1 and len(b) > 1 and a[0] == b[0]:
            a, b, p = a[1:], b[1:], p + 1
        return p, a, b

    d = spark.createDataFrame(rows, "i int, p int, a string, b string").select("i", variants.minimal_alleles(F.col("p"), F.col("a"), F.col("b")).alias("m"))
    assert {r.i: tuple(r.m) for r in d.collect()} == {i: plain(p, a, b) for i, p, a, b in rows}


def test_null_rejects_and_selection_drops(spark):
    d = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (4, float("inf"))], "i int, x double")
    kept, lost = ledger.split(d, [ledger.Rule("low", F.col("x") < 0.5)])
    assert sorted(r.i for r in kept.collect()) == [1, 3, 4] and [(r.i, r.reject_reason) for r in lost.collect()] == [(2, "low")]
    assert [r.i for r in ledger.complete_rows(d, ["x"]).collect()] == [1]
    book = ledger.Ledger("i")
    left = book.reject(d, "s", [ledger.Rule("low", F.col("x") < 0.5)])
    ledger.reconcile(d.count(), left.count(), book.rows().count())
    with pytest.raises(ValueError):
        ledger.reconcile(3, 1, 1)
    assert [tuple(r) for r in book.originals(d).select("i", "reason", "x").collect()] == [(2, "low", None)]


def test_policy_bounds():
    with pytest.raises(ValueError):
        ledger.QualityPolicy(least_maf=0.7)


@pytest.mark.parametrize("width", [1.0, 7.0, 1e9])
def test_running_and_merge(spark, width):
    rnd = random.Random(2)
    rows = [(i, rnd.choice("ab"), s := rnd.randint(0, 300), s + rnd.randint(0, 12)) for i in range(200)]
    d = spark.createDataFrame(rows, "i int, k string, s int, e int")
    got = {r.i: r.c for r in intervals.merged(d, ["k"], "s", "e", 2, ["i"], "c", width).collect()}
    for k in "ab":
        end, c = None, 0
        for i, _, s, e in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[3], r[0])):
            c += end is None or s > end + 2
            end = e if end is None else max(end, e)
            assert got[i] == c
    back = {r.i: r.v for r in scans.running(d, ["k"], "s", ["e", "i"], F.col("e"), "min", "v", width, exclusive=True).collect()}
    for k in "ab":
        low = None
        for i, _, s, e in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[3], r[0])):
            assert back[i] == low
            low = e if low is None else min(low, e)


def test_range_joins(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.choice("xy"), rnd.randint(-50, 500)) for i in range(150)] + [(999, None, 3), (1000, "x", None)]
    ivs = [(i, rnd.choice("xy"), s := rnd.randint(-60, 480), s + rnd.choice([0, 1, 3, 40, 300])) for i in range(60)] + [(500, "x", 9, 5), (501, None, 0, 9)]
    p, v = spark.createDataFrame(pts, "i int, k string, p int"), spark.createDataFrame(ivs, "j int, m string, s int, e int")
    want = {(i, j) for i, k, x in pts for j, m, s, e in ivs if k is not None and k == m and x is not None and s <= x <= e}
    got = [(r.i, r.j) for r in ranges.contains(p, v, [("k", "m")], "p", "s", "e").collect()]
    assert sorted(got) == sorted(want)
    left = [(r.i, r.j) for r in ranges.contains(p, v, [("k", "m")], "p", "s", "e", how="left").collect()]
    assert {x for x in left if x[1] is not None} == want and {i for i, _ in left} == {x[0] for x in pts}
    semi = [r.i for r in ranges.contains(p, v, [("k", "m")], "p", "s", "e", how="left_semi").collect()]
    assert sorted(semi) == sorted({i for i, _ in want})
    o = v.select(*[F.col(c).alias("o" + c) for c in v.columns])
    over = sorted((r.j, r.oj) for r in ranges.overlaps(v.filter("s <= e"), o.filter("os <= oe"), [("m", "om")], ("s", "e"), ("os", "oe")).collect())
    good = [x for x in ivs if x[1] is not None and x[2] <= x[3]]
    assert over == sorted((a[0], b[0]) for a in good for b in good if a[1] == b[1] and a[3] >= b[2] and a[2] <= b[3])


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("width", [3.0, 1e6])
def test_asof(spark, direction, width):
    rnd = random.Random(4)
    left = [(i, rnd.choice("ab"), rnd.randint(0, 200)) for i in range(80)]
    right = [(i, rnd.choice("ab"), t) for i, t in enumerate(rnd.sample(range(200), 40))]
    got = scans.asof(spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "j int, k string, t int"), ["k"], "t", ["j"], 20, direction, width)
    for r in got.collect():
        near = [(abs(t - r.t), t, j) for j, k, t in right if k == r.k and (direction == "nearest" or (t <= r.t if direction == "backward" else t >= r.t))]
        best = min(near, default=None)
        want = best[2] if best and best[0] <= 20 else None
        assert r.right_j == want


def test_global_rank_and_corrections(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([0.001, 0.01, 0.2, rnd.random()])) for i in range(120)] + [(900, None), (901, float("nan"))]
    d = corrections.adjusted(spark.createDataFrame(rows, "i int, p double"), "p", ties=["i"])
    good = sorted((p, i) for i, p in rows if p is not None and p == p)
    m, bh, holm = len(good), {}, {}
    low = 1.0
    for r in range(m, 0, -1):
        low = min(low, good[r - 1][0] * m / r)
        bh[good[r - 1][1]] = low
    high = 0.0
    for r in range(1, m + 1):
        high = max(high, good[r - 1][0] * (m - r + 1))
        holm[good[r - 1][1]] = min(high, 1.0)
    for r in d.collect():
        if r.i >= 900:
            assert r.adj_fdr_bh is None and r.adj_holm is None
        else:
            assert r.adj_fdr_bh == pytest.approx(bh[r.i]) and r.adj_holm == pytest.approx(holm[r.i])
    with pytest.raises(ValueError):
        corrections.adjusted(d, "p", ("none",))


def test_clumps_equal_plain_walk(spark):
    rnd = random.Random(6)
    v = [(f"v{i:03d}", rnd.choice("12"), rnd.randint(0, 4000), round(rnd.random() * 10, 2)) for i in range(120)]
    at = {x[0]: x for x in v}
    e = []
    for a in v:
        for b in v:
            if a[0] < b[0] and a[1] == b[1] and abs(a[2] - b[2]) <= 150 and rnd.random() < 0.5:
                e.append((a[0], b[0], round(rnd.random(), 2)))
    d = graph.clumps(spark.createDataFrame(v, "id string, chrom string, pos long, lp double"), spark.createDataFrame(e, "a string, b string, r2 double"), "id", "chrom", "pos", "lp", 6, 2, 0.4, 100)
    got = {}
    for r in d.collect():
        got.setdefault(r.index_id, set()).add(r.member)
    near = {x[0]: {x[0]} for x in v}
    for a, b, r2 in e:
        if r2 >= 0.4 and abs(at[a][2] - at[b][2]) <= 100:
            near[a].add(b)
            near[b].add(a)
    claimed, want = set(), {}
    for x in sorted((x for x in v if x[3] >= 6), key=lambda x: (-x[3], x[0])):
        if x[0] in claimed:
            continue
        members = {m for m in near[x[0]] if at[m][3] >= 2 or m == x[0]}
        want[x[0]] = members
        claimed |= {x[0]} | {m for m in members if at[m][3] >= 6}
    assert got == want


@pytest.mark.parametrize("exclusive", [False, True])
def test_clumps_by_distance_equal_those_of_edges(spark, exclusive):
    rnd = random.Random(6)
    # stretches of many variants and gaps just at, below and above twice the window
    at, v = {"1": 0, "2": 0}, []
    for i in range(1500):
        c = rnd.choice("12")
        at[c] += rnd.choice([1, 2, 3, 5, 11, 12, 13, 25, 200] if i % 50 == 0 else [1, 2, 3])
        v.append((f"v{i}", c, at[c], float(rnd.choice([1, 3, 6, 7, 8])) if rnd.random() < 0.9 else None))
    e = [(x[0], y[0], 1 - (y[2] - x[2]) / 10) for x in v for y in v if x[1] == y[1] and 0 < y[2] - x[2] <= 6]
    d, least = spark.createDataFrame(v, "id string, chrom string, pos long, lp double"), 6 if exclusive else 3
    d = d.filter("lp is not null") if exclusive else d
    want = graph.clumps(d, spark.createDataFrame(e, "a string, b string, r2 double"), "id", "chrom", "pos", "lp", 6, least, 0.6, 6, exclusive)
    want = sorted((r.index_id, r.member, r.r2) for r in want.collect())
    places = {x[0]: x[1:] for x in v}
    for leads in (1, 40, 5000):
        got = graph.clumps_by_distance(d, lambda distance: 1 - distance / 10, "id", "chrom", "pos", "lp", 6, least, 0.6, 6, exclusive, leads).collect()
        assert sorted((r.index_id, r.member, r.r2) for r in got) == want
        assert all((r.chrom, r.pos, r.score) == places[r.member] for r in got)
    alone = spark.createDataFrame([("a", None, 5, 9.0), ("b", "1", None, 9.0), ("c", "1", 5, 9.0), ("d", "1", 6, None), (None, "1", 7, 9.0)], "id string, chrom string, pos long, lp double")
    got = graph.clumps_by_distance(alone, lambda distance: 1 - distance / 10, "id", "chrom", "pos", "lp", 6, 3, 0.6, 6).collect()
    assert sorted((r.index_id, r.member) for r in got) == [("a", "a"), ("b", "b"), ("c", "c"), ("c", "d")]
    assert graph.clumps_by_distance(alone.filter("lp < 1"), lambda distance: 1 - distance / 10, "id", "chrom", "pos", "lp", 6, 3, 0.6, 6).collect() == []


def test_second_stage_clumps_shuffle_no_links(spark, tmp_path):
    """Four line items at each of many places: links outnumber them many times, but are no part of the plan."""
    from varloom.queries import QUERIES

    spark.sql("select id l_orderkey, cast(id % 7 as int) l_linenumber, 22L l_suppkey, id div 4 l_partkey, 1D l_quantity, 1e5 + id % 9 * 1e3 l_extendedprice, 0D l_discount, 0D l_tax, 'A' l_returnflag, 'O' l_linestatus from range(4000)").write.parquet(f"{tmp_path}/lineitem.parquet")
    d = QUERIES["graph_second_stage_clumps"](spark, str(tmp_path))
    assert d._jdf.queryExecution().executedPlan().toString().count("Join") <= 1
    assert d.count() > 0


def test_dependency_order():
    needs = {"a": ["b", "c"], "b": ["c"], "c": [], "d": []}
    assert graph.dependency_order(["a"], needs) == ["c", "b", "a"]
    with pytest.raises(ValueError):
        graph.dependency_order(["a"], {"a": ["b"], "b": ["a"]})
    with pytest.raises(ValueError):
        graph.dependency_order(["a"], {"a": ["z"]})


def test_ridge_stepwise_and_lasso(spark):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(200, 6))
    y = x[:, 1] * 2 - x[:, 4] + rnd.normal(size=200) * 0.1
    d = spark.createDataFrame([(i, [float(v) for v in x[i]], float(y[i])) for i in range(200)], "i int, f array<double>, y double")
    xtx, xty, yty, n = models.cross_products(d, "f", "y", 6)
    assert np.allclose(xtx, x.T @ x) and np.allclose(xty, x.T @ y) and n == 200
    w, a = models.ridge(xtx, xty, yty, n)
    assert np.allclose(w, np.linalg.solve(x.T @ x + a * np.eye(6), x.T @ y))
    assert models.stepwise(d, "f", "y", 6, 1e-6, 4) == [1, 4]
    assert set(np.flatnonzero(np.abs(models.lasso(xtx, xty, n, 0.2)) > 1e-6)) == {1, 4}
    p = {r.i: r.score for r in models.predicted(d, "f", w).collect()}
    assert p[5] == pytest.approx(float(x[5] @ w))


def test_study_decisions():
    assert inference.effect_type({"finite": 100, "non_positive": 0, "median": 1.0}) == "odds_ratio"
    assert inference.effect_type({"finite": 100, "non_positive": 50, "median": 0.0}) == "beta"
    with pytest.raises(ValueError):
        inference.effect_type({"finite": 100, "non_positive": 0, "median": 3.0})
    assert inference.p_scale({"finite": 100, "above": 0, "median": 0.5}) == "raw"
    assert inference.p_scale({"finite": 100, "above": 20, "median": 0.3}) == "neglog10"
    assert inference.info_kind({"finite": 1000, "above_2": 0, "to_2": 5}) == "mach_r2"
    assert inference.frequency_kind({"usable": 10, "minor": 10}) == "maf"
    assert joins.chosen_build([{"build": "a", "matches": 500, "markers": 1000, "testable": 510}, {"build": "b", "matches": 3, "markers": 1000, "testable": 510}]) == ("a", [])
    assert joins.chosen_build([{"build": "a", "matches": 50, "markers": 1000, "testable": 510}])[0] is None


def test_error_scale(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(300):
        odds, se = rnd.choice([0.5, 2.0]), 0.05 + rnd.random() / 10
        rows.append((odds, se * odds, math.log(odds) / se))
    assert inference.error_scale(spark.createDataFrame(rows, "o double, s double, z double"), "o", "s", "z")[0] == "odds"


def test_palindromic_states(spark):
    rows = [(1, "a", 0.1, 0.12), (1, "b", 0.1, 0.88), (2, "a", 0.5, 0.5), (3, "a", 0.1, None), (4, "a", 0.1, 0.3), (4, "b", 0.1, 0.9)]
    d = windows.palindromic_evidence(spark.createDataFrame(rows, "r int, o string, f double, x double"), "r", "f", "x")
    assert {(r.r, r.state) for r in d.collect()} == {(1, "resolved"), (2, "ambiguous_frequency_band"), (3, "unusable_frequency"), (4, "maximum_difference_exceeded")}
    assert [(r.r, r.o) for r in d.filter("winner").collect()] == [(1, "a")]


def test_effects_from_z(spark):
    d = spark.createDataFrame([(2.0, None, 0.5, 0.3, 100.0), (2.0, 0.4, None, 0.3, 100.0), (2.0, None, None, 0.3, 100.0)], "z double, b double, s double, f double, n double")
    got = d.select(numeric.effect_from_z(*[F.col(c) for c in "zbsfn"]).alias("x")).select("x.*").collect()
    assert got[0].beta == pytest.approx(1.0) and got[1].se == pytest.approx(0.2) and got[2].se == pytest.approx(1 / math.sqrt(0.42 * 100))


def test_duplicates_by_policy(spark):
    d = spark.createDataFrame([(1, "a", 3.0), (2, "a", 3.0), (3, "b", 1.0), (4, "b", 2.0), (5, "c", None)], "r int, i string, s double")
    ids = lambda p: sorted(r.r for r in windows.resolve_identifiers(d, "i", p, F.col("s"), "r").collect())
    assert ids("allow") == [1, 2, 3, 4, 5] and ids("unique_best") in ([1, 4], [2, 4]) and ids("exclude_all") in ([1, 5], [2, 5]) and ids("first_best") in ([1, 4, 5], [2, 4, 5])
    with pytest.raises(ValueError):
        ids("error")


def test_sources(spark, tmp_path):
    f = tmp_path / "t.tsv"
    f.write_text("##meta\n#a\tb\n1\tNA\nx\t2.5\n")
    assert delimited.detect_delimiter(spark, str(f)) == "\t"
    g = tmp_path / "u.csv"
    g.write_text("a,b\n1,NA\nx,2.5\n")
    d = delimited.typed(delimited.read_strings(spark, str(g), ",", ["a", "b"]), {"a": "bigint", "b": "double"})
    assert [tuple(r) for r in d.collect()] == [(1, None), (None, 2.5)]
    with pytest.raises(ValueError):
        delimited.read_strings(spark, str(g), ",", ["z"])
    import lzma

    (tmp_path / "v.txt.xz").write_bytes(lzma.compress(b"one\ntwo\n"))
    assert [r.value for r in delimited.read_lines(spark, str(tmp_path / "v.txt.xz")).collect()] == ["one", "two"]
    s = tmp_path / "sets.txt"
    s.write_text("S1\nv1\nv2\nEND\n\nS2\nv3\nEND\n")
    assert [(r.set, r.member) for r in genomic.block_sets(spark, str(s)).collect()] == [("S1", "v1"), ("S1", "v2"), ("S2", "v3")]
    np.save(tmp_path / "m.mat.0.npy", np.arange(6.0).reshape(2, 3))
    assert {(r.chunk, r.gene): r["values"] for r in genomic.matrix_rows(spark, str(tmp_path / "m"), ["g1", "g2"]).collect()}[(0, "g2")] == [3.0, 4.0, 5.0]
    (tmp_path / "b.bed").write_bytes(bytes([0x6C, 0x1B, 0x01, 0b11100100, 0b00000011]))
    assert [r.calls for r in genomic.genotypes(spark, str(tmp_path / "b.bed"), 4).orderBy("row").collect()] == [[2, None, 1, 0], [0, 2, 2, 2]]
    lines = ['##INFO=<ID=AF,Number=A,Type=Float,Description="x">', '##FORMAT=<ID=ES,Number=A,Type=Float,Description="y">']
    assert vcf.definitions(lines, "INFO") == {"AF": ("A", "Float")}


def test_publish_restores(spark, tmp_path):
    for n in ("new", "old"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "f").write_text(n)
    sinks.publish(spark, [(str(tmp_path / "new"), str(tmp_path / "old"))])
    assert (tmp_path / "old" / "f").read_text() == "new"
    (tmp_path / "next").mkdir()
    with pytest.raises(Exception):
        sinks.publish(spark, [(str(tmp_path / "next"), str(tmp_path / "old")), (str(tmp_path / "missing"), str(tmp_path / "other"))])
    assert (tmp_path / "old" / "f").read_text() == "new"


def test_constant_correlation_is_null(spark):
    d = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert aggregates.concordance(d, "a", "b").first().pearson is None


def test_empty_tables(spark):
    d = spark.createDataFrame([], "i int, k string, s int, e int, p double")
    assert intervals.merged(d, ["k"], "s", "e", 1, ["i"]).count() == 0
    assert corrections.adjusted(d, "p", ties=["i"]).count() == 0
    assert ranges.contains(d.select(F.col("i").alias("pi"), F.col("k").alias("pk"), F.col("s").alias("ps")), d, [("pk", "k")], "ps", "s", "e").count() == 0


def test_list_set_difference(spark):
    d = spark.createDataFrame([(["a", "b", None], ["b"])], "x array<string>, y array<string>")
    assert d.select(sets_of.difference(F.col("x"), F.col("y"))).first()[0] == ["a", None]


def test_whitening(spark, tmp_path):
    (tmp_path / "raw").write_text("# VERSION\ng1 1 10 20 5 2 100 3 1.5\ng2 1 30 40 5 2 100 3 0.5 0.4\ng3 1 50 60 5 2 100 3 -0.5 0.1 0.3\nh1 2 10 20 5 2 100 3 2.0\n")
    genes, cov = genomic.gene_covariance(spark, str(tmp_path / "raw"))
    assert {(r.gene_a, r.gene_b, r.r) for r in cov.collect()} == {("g2", "g1", 0.4), ("g3", "g1", 0.1), ("g3", "g2", 0.3)}
    d = genes.withColumn("f", F.array(F.col("start").cast("double"), F.lit(2.0)))
    got = {r.gene: r for r in models.whitened(d, cov, "chrom", "gene", "z", "f").collect()}
    m = 0.999 * np.array([[1, 0.4, 0.1, 0], [0.4, 1, 0.3, 0], [0.1, 0.3, 1, 0], [0, 0, 0, 1]]) + 0.001 * np.eye(4)
    w = np.linalg.inv(np.linalg.cholesky(m))
    x = w @ np.column_stack([[1.5, 0.5, -0.5, 2.0], np.ones(4), [10, 30, 50, 10], [2.0] * 4])
    one = x[:, 1]
    out = x - np.outer(one, one @ x / (one @ one))
    for i, g in enumerate(["g1", "g2", "g3", "h1"]):
        assert got[g].z == pytest.approx(out[i, 0]) and np.allclose(got[g].f, out[i, 2:])


def test_chromosome_place_covers_all_rows(spark):
    from tests.conftest import SMALL
    from varloom.queries import QUERIES

    d = QUERIES["sort_chromosome_place"](spark, SMALL).orderBy("place").collect()
    assert [r.place for r in d] == list(range(1, spark.read.parquet(f"{SMALL}/lineitem.parquet").count() + 1))
    chroms = [int(r.chrom) for r in d]
    assert chroms == sorted(chroms) and len(set(chroms)) > 1


def test_long_preamble_and_hash_header(spark, tmp_path):
    f = tmp_path / "x.tsv"
    f.write_text("".join(f"##contig={i}\n" for i in range(2500)) + "#CHR\tPOS\n1\t5\n#2\t\"6\"\n")
    assert delimited.header_of(spark, str(f), "\t") == (["CHR", "POS"], 2500)
    got = delimited.read_strings(spark, str(f), "\t", comment="##").collect()
    assert [tuple(r) for r in got] == [("1", "5"), ("#2", "6")]


def plain_left_aligned(seq, pos, ref, alt):
    """One base at a time: cut the shared last base, borrow the base before where an allele is empty."""
    while True:
        if ref and alt and ref[-1] == alt[-1] and (len(ref) > 1 and len(alt) > 1 or pos > 1):
            ref, alt = ref[:-1], alt[:-1]
            if not ref or not alt:
                pos -= 1
                ref, alt = seq[pos - 1] + ref, seq[pos - 1] + alt
        else:
            break
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


def test_left_alignment_equals_plain_steps(spark):
    import random

    from varloom.operators import normalise

    r = random.Random(2)
    seq = "".join(r.choices("AC", k=60)) + "ACACAC" * 20 + "".join(r.choices("ACGT", k=60)) + "G" * 50 + "T"
    rows = []
    for i in range(150):
        p, k = r.randint(1, len(seq) - 6), r.randint(1, 5)
        if i % 3 == 0:
            rows.append((i, "1", p, seq[p - 1 : p + k], seq[p - 1]))
        elif i % 3 == 1:
            u = seq[max(0, p - k) : p]
            rows.append((i, "1", p, seq[p - 1], seq[p - 1] + u))
        else:
            rows.append((i, "1", p, seq[p - 1], r.choice("ACGT")))
    made = spark.createDataFrame(rows + [(900, "2", 5, "AT", "A"), (901, None, None, None, None)], "id long, chrom string, pos long, ref string, alt string")
    chunks = normalise.reference_chunks(spark.createDataFrame([("1", seq)], "chrom string, seq string"), 16)
    got = {x.id: (x.norm_pos, x.norm_ref, x.norm_alt) for x in normalise.left_aligned(made, chunks, 16).collect()}
    assert len(got) == len(rows) + 2 and got[900] == (5, "AT", "A") and got[901] == (None, None, None)
    for i, _, p, a, b in rows:
        if a != b:
            assert got[i] == plain_left_aligned(seq, p, a, b), (p, a, b)


def test_vcf_parts_are_whole(spark, tmp_path):
    from varloom.sources import vcf

    d = spark.createDataFrame([("1", 5, "rs1", "A", "G", 0.5, 100.0), ("2", 3, "rs2", "C", "T", None, 7.6), ("1", 2, None, "G", "T", 0.1, None)], "CHROM string, POS long, ID string, REF string, ALT string, ES double, SS double")
    vcf.write_gwas(d, str(tmp_path / "a"), {"1": 10, "2": 10}, "trait", "GRCh38")
    parts = [p for p in (tmp_path / "a").glob("part-*") if p.stat().st_size]
    body = []
    for p in parts:
        lines = p.read_text().splitlines()
        assert lines[0] == "##fileformat=VCFv4.2" and sum(x.startswith("#CHROM") for x in lines) == 1
        assert any("ID=SS,Number=A,Type=Integer" in x for x in lines)
        body += [x for x in lines if not x.startswith("#")]
    assert {x.split("\t")[-1] for x in body} == {"0.5:100:rs1", ".:8:rs2", "0.1:.:."}
    assert [r.ID for r in vcf.read(spark, str(tmp_path / "a"), region=("1", 3, 9)).collect()] == ["rs1"]
    assert vcf.read(spark, str(tmp_path / "a"), sample="trait").count() == 3
    with pytest.raises(ValueError, match="no sample"):
        vcf.read(spark, str(tmp_path / "a"), sample="other")
    vcf.write_gwas(d.limit(0), str(tmp_path / "b"), {"1": 10}, "trait", "GRCh38")
    assert "#CHROM" in "".join(p.read_text() for p in (tmp_path / "b").glob("part-*")) and vcf.read(spark, str(tmp_path / "b")).count() == 0


def test_heritability_is_found(spark):
    import numpy as np

    from varloom.operators import models

    r = np.random.default_rng(0)
    n, m = 50_000.0, 200_000.0
    score = r.gamma(2, 40, 20_000)
    chi2 = (1.1 + n * 0.3 * score / m) * r.chisquare(1, 20_000)
    d = spark.createDataFrame([(float(a), float(b), n) for a, b in zip(chi2, score)] + [(None, 1.0, n), (float("nan"), 1.0, n)], "chi2 double, score double, n double")
    got = models.heritability(d, "chi2", "score", "n", m)
    assert abs(got["h2"] - 0.3) < 4 * got["h2_se"] < 0.1 and abs(got["intercept"] - 1.1) < 4 * got["intercept_se"]
    assert np.isnan(models.heritability(d.limit(0), "chi2", "score", "n", m)["h2"])


def test_ranks_medians_and_families(spark):
    import numpy as np

    from varloom.operators import aggregates, corrections, ranges, scans, windows

    r = np.random.default_rng(1)
    rows = [(int(g), float(x), float(y)) for g, x, y in zip(r.integers(0, 3, 400), r.integers(0, 25, 400), r.random(400))] + [(7, 1.0, 0.5), (8, None, None)]
    d = spark.createDataFrame(rows, "g int, x double, y double")
    for keys in ([], ["g"]):
        got = sorted((t.g, t.x, t.r) for t in windows.with_average_rank(d.filter("x is not null"), keys, "x", "r").collect())
        want = []
        for g, x, _ in rows:
            if x is not None:
                mine = [b for a, b, _ in rows if b is not None and (not keys or a == g)]
                want.append((g, x, sum(b < x for b in mine) + (sum(b == x for b in mine) + 1) / 2))
        assert got == sorted(want)
    some = {t.g: t for t in scans.quantiles(d, "x", {"low": 0.25, "mid": 0.5}, ["g"]).collect()}
    for g in (0, 1, 2, 7):
        mine = [x for a, x, _ in rows if a == g and x is not None]
        assert some[g].mid == np.median(mine) and some[g].low == np.quantile(mine, 0.25)
    assert 8 not in some and aggregates.frequency_summary(d.filter("g = 8"), "y").first().median is None
    adj = {(t.g, t.y): t.adj_fdr_bh for t in corrections.adjusted(d, "y", ("fdr_bh", "holm"), family=["g"], ties=["x"]).collect()}
    for g in (0, 7):
        p = np.sort([y for a, _, y in rows if a == g])
        q = np.minimum.accumulate((p * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
        assert all(abs(adj[g, float(a)] - min(b, 1)) < 1e-12 for a, b in zip(p, q))
    points = spark.createDataFrame([("1", 5), ("1", 5), ("1", 50)], "c string, p long")
    spans = spark.createDataFrame([("1", 1, 9), ("1", 4, 6)], "k string, s long, e long")
    assert ranges.contains(points, spans, [("c", "k")], "p", "s", "e", "left_semi").count() == 2


def test_parsed_integers_keep_every_digit(spark):
    from pyspark.sql import functions as F

    from varloom.functions import variants

    d = spark.createDataFrame([("9007199254740993",), ("1,234",), ("1e3",), ("1.5",), ("x",), (None,)], "t string")
    assert [r[0] for r in d.select(variants.parsed_integer(F.col("t"))).collect()] == [9007199254740993, 1234, 1000, None, None, None]

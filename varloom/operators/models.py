"""Marginal regressions, prediction, locus scoring and scores of contained regions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dot
from ..functions.special import erfc
from ..functions.variants import finite
from .ranges import contains
from .windows import scaled_in_group


def long_features(df: DataFrame, keys: list[str], features: str) -> DataFrame:
    """A row per element of an array column: feature (its place), x."""
    return df.select(*keys, F.posexplode(features).alias("feature", "x")).withColumn("x", F.col("x").cast("double"))


def marginal_ols(long: DataFrame, y: str, x: str, feature: str, constant: float = 1e-12) -> DataFrame:
    """Per feature the regression of y on x through the origin: beta, se, z, p (chi-squared, 1 df), r2.

    Sums are partial aggregates. A feature that is nearly constant zero has nulls.
    """
    s = long.groupBy(feature).agg(F.count("*").alias("n"), F.sum(F.col(x) * F.col(y)).alias("sxy"), F.sum(F.col(x) * F.col(x)).alias("sxx"), F.sum(F.col(y) * F.col(y)).alias("syy"))
    ok = F.col("sxx") > constant
    beta = F.when(ok, F.col("sxy") / F.col("sxx"))
    rss = F.greatest(F.col("syy") - beta * F.col("sxy"), F.lit(0.0))
    out = s.withColumn("beta", beta).withColumn("se", F.sqrt(rss / (F.col("n") - 1) / F.col("sxx")))
    out = out.withColumn("z", F.when(F.col("se") > 0, F.col("beta") / F.col("se")))
    return out.withColumn("p", erfc(F.abs("z") / F.sqrt(F.lit(2.0)))).withColumn("r2", F.when(F.col("syy") > 0, 1 - rss / F.col("syy"))).drop("sxy", "sxx", "syy")


def selected_features(assoc: DataFrame, p: str, feature: str, cutoff: float | None, most: int | None, controls: list | None = None) -> DataFrame:
    """Features at or under the cutoff, the best `most` of them, and the controls."""
    control = F.col(feature).isin(controls or [])
    got = assoc.filter(~control & F.col(p).isNotNull())
    if cutoff is not None:
        got = got.filter(F.col(p) <= cutoff)
    if most is not None:
        got = got.orderBy(F.asc(p), F.asc(feature)).limit(most)
    return got.unionByName(assoc.filter(control)) if controls else got


def cross_products(df: DataFrame, features: str, y: str, n: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """X'X, X'y, y'y and rows: sums over all rows by partition, of which the driver gets n * n numbers each."""

    def run(batches):
        import pandas as pd

        xtx, xty, yty, rows = np.zeros((n, n)), np.zeros(n), 0.0, 0
        for pdf in batches:
            if len(pdf):
                x, t = np.stack(pdf[features].to_numpy()).astype(float), pdf[y].to_numpy(float)
                xtx += x.T @ x
                xty += x.T @ t
                yty += float(t @ t)
                rows += len(pdf)
        yield pd.DataFrame({"i": np.arange(n), "row": list(xtx), "xty": xty, "yty": yty, "n": rows})

    parts = df.select(features, y).mapInPandas(run, "i int, row array<double>, xty double, yty double, n long")
    each = parts.groupBy("i").agg(F.array(*[F.sum(F.col("row")[j]) for j in range(n)]).alias("row"), F.sum("xty").alias("xty"), F.sum("yty").alias("yty"), F.sum("n").alias("n")).orderBy("i").collect()
    return np.array([r["row"] for r in each]), np.array([r["xty"] for r in each]), each[0]["yty"], each[0]["n"]


ALPHAS = np.logspace(-2, 10, 25)


def ridge(xtx: np.ndarray, xty: np.ndarray, yty: float, rows: int, alphas: np.ndarray = ALPHAS) -> tuple[np.ndarray, float]:
    """Coefficients and penalty of least generalised cross-validation error, from the cross products alone."""
    values, vectors = np.linalg.eigh(xtx)
    values = np.maximum(values, 0)
    t = vectors.T @ xty
    best = None
    for a in alphas:
        w = t / (values + a)
        rss = yty - 2 * float(w @ t) + float(w * w @ values)
        free = rows - float((values / (values + a)).sum())
        gcv = rows * max(rss, 0.0) / max(free, 1e-9) ** 2
        if best is None or gcv < best[0]:
            best = (gcv, vectors @ w, float(a))
    return best[1], best[2]


def lasso(xtx: np.ndarray, xty: np.ndarray, rows: int, alpha: float, rounds: int = 1000, tolerance: float = 1e-9) -> np.ndarray:
    """Coordinate descent on the cross products; alpha is the penalty per row."""
    w = np.zeros(len(xty))
    for _ in range(rounds):
        most = 0.0
        for j in range(len(w)):
            if xtx[j, j] <= 0:
                continue
            r = xty[j] - xtx[j] @ w + xtx[j, j] * w[j]
            new = np.sign(r) * max(abs(r) - alpha * rows, 0.0) / xtx[j, j]
            most = max(most, abs(new - w[j]))
            w[j] = new
        if most < tolerance:
            break
    return w


def predicted(df: DataFrame, features: str, coefficients: np.ndarray, out: str = "score") -> DataFrame:
    """The scalar product with the coefficients, in the JVM."""
    return df.withColumn(out, dot(F.col(features), F.array(*[F.lit(float(c)) for c in coefficients])))


def stepwise(df: DataFrame, features: str, y: str, n: int, cutoff: float, most: int) -> list[int]:
    """Forward selection: the feature of least p given those chosen, until none is under the cutoff. One pass over the rows."""
    xtx, xty, yty, rows = cross_products(df, features, y, n)
    chosen: list[int] = []
    while len(chosen) < most:
        left = [j for j in range(n) if j not in chosen]
        if not left:
            break
        if chosen:
            inv = np.linalg.pinv(xtx[np.ix_(chosen, chosen)])
            sxx = np.array([xtx[j, j] - xtx[j, chosen] @ inv @ xtx[chosen, j] for j in left])
            sxy = np.array([xty[j] - xtx[j, chosen] @ inv @ xty[chosen] for j in left])
            syy = yty - xty[chosen] @ inv @ xty[chosen]
        else:
            sxx, sxy, syy = np.array([xtx[j, j] for j in left]), np.array([xty[j] for j in left]), yty
        with np.errstate(all="ignore"):
            beta = np.where(sxx > 1e-12, sxy / sxx, 0.0)
            se = np.sqrt(np.maximum(syy - beta * sxy, 1e-300) / max(1, rows - len(chosen) - 1) / sxx)
            z = np.where(sxx > 1e-12, np.abs(beta / se), 0.0)
        k = int(z.argmax())
        if math.erfc(z[k] / math.sqrt(2)) > cutoff:
            break
        chosen.append(left[k])
    return chosen


def control_covariates(df: DataFrame, size: str, density: str, mac: str) -> DataFrame:
    """Size, density and inverse count with their logarithms."""
    inverse = F.when(F.col(mac) > 0, 1.0 / F.col(mac))
    return df.withColumns({"log_size": F.log(F.col(size).cast("double")), "log_density": F.log(F.col(density).cast("double")), "inv_mac": inverse, "log_inv_mac": F.log(inverse)})


def contained_scores(regions: DataFrame, variants: DataFrame, keys: list[tuple[str, str]], start: str, end: str, pos: str, pip: str, score: Column, group: str) -> DataFrame:
    """Per group the sum and greatest of score times probability over regions and the variants in them, 0 without any."""
    met = contains(variants, regions, keys, pos, start, end).select(F.col(group), (score * F.col(pip)).alias("s"))
    got = met.groupBy(group).agg(F.sum("s").alias("score_sum"), F.max("s").alias("score_max"))
    return regions.select(group).distinct().join(got, group, "left").fillna(0.0, ["score_sum", "score_max"])


def heritability(df: DataFrame, chi2: str, score: str, n: str, markers: float, rounds: int = 2, blocks: int = 200, order: str | None = None, block_width: float = 1e7) -> dict[str, float]:
    """Heritability by regression of test statistics on linkage scores: h2, intercept and, with blocks, their errors.

    E[chi2] = n h2 score / markers + intercept, weighted by 1 / (score (1 + n h2 score / markers) ** 2)
    with the estimate of the round before, the first from the means. A round is one aggregation:
    five sums for each block of rows (`block_width` wide along `order`, which neighbours share, else by a hash); the driver solves two equations.
    Errors are the jackknife's over blocks.
    """
    rows = df.filter(finite(F.col(chi2)) & finite(F.col(score)) & finite(F.col(n)))
    block = F.floor(F.col(order) / F.lit(block_width)) if order else F.pmod(F.xxhash64(chi2, score, n), F.lit(max(1, blocks)))
    means = rows.agg(F.avg(chi2), F.avg(F.col(n) * F.col(score))).first()
    if means[0] is None:
        return {"h2": math.nan, "intercept": math.nan, "h2_se": math.nan, "intercept_se": math.nan}
    h2 = min(max(markers * (means[0] - 1) / means[1], 0.0), 1.0) if means[1] else 0.0
    size = F.greatest(F.col(score), F.lit(1.0))
    x, y = F.col(n) * F.col(score) / F.lit(float(markers)), F.col(chi2)

    def solved(s: np.ndarray) -> tuple[float, float]:
        w, wx, wy, wxx, wxy = s
        slope = (w * wxy - wx * wy) / (w * wxx - wx * wx)
        return float(slope), float((wy - slope * wx) / w)

    for _ in range(max(1, rounds)):
        fit = F.lit(1.0) + F.lit(min(max(h2, 0.0), 1.0)) * F.col(n) * size / F.lit(float(markers))
        w = 1.0 / (size * fit * fit)
        sums = rows.groupBy(block.alias("b")).agg(F.sum(w), F.sum(w * x), F.sum(w * y), F.sum(w * x * x), F.sum(w * x * y)).collect()
        parts = np.array([r[1:] for r in sums], float)
        h2, intercept = solved(parts.sum(0))
    out = {"h2": h2, "intercept": intercept, "h2_se": math.nan, "intercept_se": math.nan}
    if len(parts) > 1:
        left = np.array([solved(parts.sum(0) - p) for p in parts])
        m = len(parts)
        out["h2_se"], out["intercept_se"] = np.sqrt((m - 1) / m * ((left - left.mean(0)) ** 2).sum(0)).tolist()
    return out


def centroids(credible: DataFrame, locus: str, pos: str, pip: str) -> DataFrame:
    return credible.groupBy(locus).agg((F.sum(F.col(pos) * F.col(pip)) / F.sum(pip)).alias("centroid"), F.count("*").alias("set_size"), F.max(pip).alias("max_pip"))


def tss_distances(genes: DataFrame, centres: DataFrame, locus: str, start: str, end: str, strand: str) -> DataFrame:
    """Distance of each gene's start of transcription to the centroid, 0 where the gene holds it."""
    c = F.col("centroid")
    tss = F.when(F.col(strand) == "-", F.col(end)).otherwise(F.col(start))
    return genes.join(centres, locus).withColumn("distance", F.when((c > F.col(start)) & (c < F.col(end)), 0.0).otherwise(F.abs(tss - c)))


def locus_counts(genes: DataFrame, locus: str, distance: str, kb: tuple[int, ...] = (50, 100, 250)) -> DataFrame:
    return genes.groupBy(locus).agg(*[F.count_if(F.col(distance) <= k * 1000).alias(f"genes_{k}kb") for k in kb], F.count("*").alias("genes"))


def consequence_scores(df: DataFrame, gene: str, variant: str, impact: str, pip: str) -> DataFrame:
    """Impact weight times probability: the greatest per gene and variant, then sum and greatest per gene."""
    weight = F.when(F.col(impact) == "HIGH", 1.0).when(F.col(impact) == "MODERATE", 0.6).when(F.col(impact) == "LOW", 0.4).when(F.col(impact) == "MODIFIER", 0.1).otherwise(0.0)
    one = df.groupBy(gene, variant).agg(F.max(weight * F.col(pip)).alias("s"))
    return one.groupBy(gene).agg(F.sum("s").alias("consequence_sum"), F.max("s").alias("consequence_max"))


def locus_scores(df: DataFrame, locus: str, probability: str, prior: str, weight: float = 0.583, floor: float = 0.292, raw_least: float = 0.134, scaled_least: float = 0.248) -> DataFrame:
    """Scores of a locus's genes from a model's probability and a second score scaled into [floor, 1]."""
    w = Window.partitionBy(locus)
    df = scaled_in_group(df, [locus], prior, "__s")
    share = floor + (1 - floor) * F.coalesce(F.col("__s"), F.lit(0.0))
    share = share / F.max(share).over(w)
    x = F.col(probability)
    df = df.withColumn("raw", x * share + weight * x * F.floor(share).cast("double"))
    df = df.withColumn("scaled", F.col("raw") / F.sum("raw").over(w))
    df = df.withColumn("highest", F.floor(F.col("scaled") / F.max("scaled").over(w)).cast("int"))
    return df.withColumn("causal", (F.col("raw") > raw_least) & (F.col("scaled") > scaled_least) & (F.col("highest") == 1)).drop("__s")


def f1_grid(df: DataFrame, truth: Column, score: str, low: float, high: float, steps: int) -> DataFrame:
    """Precision, recall and F1 of score >= t for each threshold, in one pass.

    Scores are counted by the number of thresholds they reach; sums from the top give each
    threshold's counts, so rows aren't multiplied by thresholds.
    """
    width = (high - low) / (steps - 1)
    reach = F.least(F.floor((F.col(score) - low) / width + 1e-9), F.lit(steps - 1)).cast("int")
    got = df.filter(F.col(score).isNotNull()).groupBy(reach.alias("k")).agg(F.count_if(truth).alias("tp"), F.count("*").alias("n"))
    total = df.agg(F.count_if(truth)).first()[0]
    grid = df.sparkSession.range(steps).select(F.col("id").cast("int").alias("k"))
    down = Window.orderBy(F.desc("k"))
    got = grid.join(got, "k", "left").fillna(0).withColumn("tp", F.sum("tp").over(down)).withColumn("n", F.sum("n").over(down))
    precision, recall = F.when(F.col("n") > 0, F.col("tp") / F.col("n")), F.lit(1.0) * F.col("tp") / F.lit(max(total, 1))
    out = got.select((F.lit(low) + F.col("k") * width).alias("threshold"), precision.alias("precision"), recall.alias("recall"))
    return out.withColumn("f1", F.when((F.col("precision") + F.col("recall")) > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def whitened(genes: DataFrame, covariance: DataFrame, chrom: str, gene: str, y: str, features: str, shrink: float = 1e-3) -> DataFrame:
    """y and features times the inverse Cholesky factor of their chromosome's covariance, then without the mean's direction.

    covariance: (chrom, gene_a, gene_b, r) triples of one triangle; the diagonal is one. Blocks are
    as large as a chromosome has genes, a few thousand; each is solved in a task of its own.
    """

    def solve(key, left, right):
        import pandas as pd

        left = left.sort_values(gene).reset_index(drop=True)
        at = {g: i for i, g in enumerate(left[gene])}
        m = np.eye(len(left))
        for a, b, r in zip(right["gene_a"], right["gene_b"], right["r"]):
            if a in at and b in at and a != b:
                m[at[a], at[b]] = m[at[b], at[a]] = r
        m = (1 - shrink) * m + shrink * np.eye(len(left))
        least = np.linalg.eigvalsh(m)[0] if len(left) else 1.0
        if least < shrink:
            m += (shrink - least) * np.eye(len(left))
        factor = np.linalg.cholesky(m)
        x = np.column_stack([left[y].to_numpy(float), np.ones(len(left)), np.stack(left[features].to_numpy()).astype(float)])
        z = np.linalg.solve(factor, x)
        return pd.DataFrame({chrom: left[chrom], gene: left[gene], y: z[:, 0], "intercept": z[:, 1], features: list(z[:, 2:])})

    types = dict(genes.dtypes)
    schema = f"`{chrom}` {types[chrom]}, `{gene}` {types[gene]}, `{y}` double, intercept double, `{features}` array<double>"
    white = genes.select(chrom, gene, y, features).groupBy(chrom).cogroup(covariance.select(F.col("chrom").alias(chrom), "gene_a", "gene_b", "r").groupBy(chrom)).applyInPandas(solve, schema)
    n = len(genes.select(features).first()[0])
    # without the intercept's direction: sums over all rows, n + 2 numbers
    one = white.agg(F.sum(F.col("intercept") * F.col("intercept")).alias("ii"), F.sum(F.col("intercept") * F.col(y)).alias("iy"), *[F.sum(F.col("intercept") * F.col(features)[j]).alias(f"x{j}") for j in range(n)]).first()
    share = [(one[f"x{j}"] or 0.0) / (one["ii"] or 1.0) for j in range(n)]
    less = F.zip_with(features, F.array(*[F.lit(float(s)) for s in share]), lambda v, s: v - s * F.col("intercept"))
    return white.select(chrom, gene, (F.col(y) - F.lit((one["iy"] or 0.0) / (one["ii"] or 1.0)) * F.col("intercept")).alias(y), less.alias(features))

"""Greedy clumping of linked variants, neighbourhoods, hubs and stepwise selection."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import written
from .intervals import gap_groups


def neighbourhood(edges: DataFrame, variants: DataFrame, a: str, b: str, r2: str, identifier: str, chrom: str, pos: str, least_r2: float, window: int) -> DataFrame:
    """Each variant's partners (itself with r2 1) at least least_r2 and at most window apart, the strongest edge of a pair."""
    left = variants.select(F.col(identifier).alias("a"), F.col(chrom).alias("chrom"), F.col(pos).alias("pos_a"))
    right = variants.select(F.col(identifier).alias("b"), F.col(chrom).alias("chrom_b"), F.col(pos).alias("pos_b"))
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(r2).alias("r2")).unionByName(edges.select(F.col(b).alias("a"), F.col(a).alias("b"), F.col(r2).alias("r2")))
    both = both.filter((F.col("r2") >= least_r2) & (F.col("a") != F.col("b"))).groupBy("a", "b").agg(F.max("r2").alias("r2"))
    met = both.join(left, "a").join(right, "b").filter((F.col("chrom") == F.col("chrom_b")) & (F.abs(F.col("pos_a") - F.col("pos_b")) <= window))
    own = left.select("a", F.col("a").alias("b"), F.lit(1.0).alias("r2"), "chrom", "pos_a", F.col("pos_a").alias("pos_b"))
    return met.select("a", "b", "r2", "chrom", "pos_a", "pos_b").unionByName(own)


def _walk(pdf: pd.DataFrame, exclusive: bool) -> pd.DataFrame:
    """Candidates by falling score then identifier; an unclaimed one becomes index and claims its partners that are candidates."""
    linked: dict[object, list[tuple]] = {}
    score: dict[object, float] = {}
    for a, b, r2, s in zip(pdf["a"], pdf["b"], pdf["r2"], pdf["score"]):
        linked.setdefault(a, []).append((b, r2))
        score[a] = s
    order = sorted(score, key=lambda v: (-score[v] if score[v] == score[v] else np.inf, v))
    claimed: set = set()
    rows = []
    for v in order:
        if v in claimed:
            continue
        for member, r2 in linked[v]:
            if exclusive and member in claimed:
                continue
            rows.append((v, member, r2))
        claimed.add(v)
        claimed.update(m for m, _ in linked[v] if m in score)
    out = pd.DataFrame(rows, columns=["index_id", "member", "r2"])
    out["chrom"], out["island"] = pdf["chrom"].iloc[0], pdf["island"].iloc[0]
    return out


def clumps(variants: DataFrame, edges: DataFrame, identifier: str, chrom: str, pos: str, lp: str, lead_lp: float, candidate_lp: float, least_r2: float = 0.6, window: int = 250_000, exclusive: bool = False) -> DataFrame:
    """Greedy clumps: index_id, member, r2, chrom.

    variants at lead_lp or more are candidates for an index; members are partners at candidate_lp
    or more, partners known to the reference alone (null score), and the index itself. The walk is
    sequential, but candidates more than a window apart never meet: each island of a chromosome,
    cut where the gap between candidates exceeds twice the window, is a group of its own.
    """
    near = neighbourhood(edges, variants, "a", "b", "r2", identifier, chrom, pos, least_r2, window)
    score = variants.select(F.col(identifier).alias("__i"), F.col(lp).alias("__lp"))
    leads = variants.filter(F.col(lp) >= lead_lp).select(F.col(identifier).alias("__lead"), F.col(lp).alias("score"), F.col(chrom).alias("__c"), F.col(pos).alias("__p"))
    leads = written(gap_groups(leads, ["__c"], "__p", 2 * window, ["__lead"], "island", width=max(1.0, 20.0 * window)), "islands")
    members = near.join(score, F.col("b") == F.col("__i")).filter(F.col("__lp").isNull() | (F.col("__lp") >= candidate_lp) | (F.col("a") == F.col("b")))
    rows = members.join(leads, F.col("a") == F.col("__lead")).select("chrom", "island", "a", "b", "r2", "score")
    types = dict(rows.dtypes)
    schema = f"index_id {types['a']}, member {types['b']}, r2 double, chrom {types['chrom']}, island bigint"
    return rows.groupBy("chrom", "island").applyInPandas(lambda pdf: _walk(pdf, exclusive), schema)


def _blocks(leads: DataFrame, chrom: str, pos: str, window: int, leads_a_block: int, most: int) -> tuple[float, DataFrame]:
    """Width of blocks of positions, and (__bc, __bb, __from, __before) of each: where its first island begins, and the block in which the one before did.

    An island begins at a lead more than twice the window past the lead before. In bins of that
    width the lead before can only be in the same bin or the next lower one. A block holds about
    leads_a_block leads, and there are about `most` in all, so their table is made on the driver.
    """
    spark, wide = leads.sparkSession, max(2 * window, 1)
    bins = leads.groupBy(F.col(chrom).alias("c"), F.floor(F.col(pos) / wide).alias("b")).agg(F.min(pos).alias("lo"), F.max(pos).alias("hi"), F.count("*").alias("n"))
    pairs = bins.select("c", F.explode(F.array(F.struct("b", "lo", "hi", "n", F.lit(None).cast(bins.schema["hi"].dataType).alias("prev")), F.struct((F.col("b") + 1).alias("b"), F.lit(None).cast(bins.schema["lo"].dataType).alias("lo"), F.lit(None).cast(bins.schema["hi"].dataType).alias("hi"), F.lit(0).cast("bigint").alias("n"), F.col("hi").alias("prev")))).alias("x"))
    met = pairs.groupBy("c", F.col("x.b").alias("b")).agg(F.max("x.lo").alias("lo"), F.max("x.hi").alias("hi"), F.sum("x.n").alias("n"), F.max("x.prev").alias("prev")).filter("lo is not null")
    begins = F.when(F.col("prev").isNull() | (F.col("lo") - F.col("prev") > 2 * window), F.col("lo") - window)
    met = written(met.select("c", begins.alias("s"), "hi", "n"), "islands")
    spans = {r[0]: r[1:] for r in met.groupBy("c").agg(F.min("s"), F.max("hi"), F.sum("n")).collect()}
    blocks = min(most, 1 + sum(n for _, _, n in spans.values()) // leads_a_block)
    width = max(float(wide), sum(float(hi - lo) for lo, hi, _ in spans.values()) / blocks)
    firsts = met.filter("s is not null").groupBy("c", F.floor(F.col("s") / F.lit(width)).alias("b")).agg(F.min("s").alias("s")).collect()
    at: dict[object, dict[int, float]] = {}
    for c, b, start in firsts:
        at.setdefault(c, {})[b] = float(start)
    rows = []
    for c, starts in at.items():
        before = None
        for b in range(min(starts), int((float(spans[c][1]) + window) // width) + 1):
            rows.append((c, b, starts.get(b), before))
            before = b if b in starts else before
    return width, spark.createDataFrame(rows, f"__bc {dict(leads.dtypes)[chrom]}, __bb bigint, __from double, __before bigint")


def _walk_places(pdf: pd.DataFrame, link: Callable[[np.ndarray], np.ndarray], least_r2: float, window: int, exclusive: bool) -> pd.DataFrame:
    """As _walk, with partners looked up by position."""
    pdf = pdf.sort_values("pos", kind="stable")
    pos, ids, score = pdf["pos"].to_numpy(), pdf["id"].to_numpy(), pdf["score"].to_numpy(np.float64, na_value=np.nan)
    lead, member = pdf["lead"].to_numpy(bool), pdf["member"].to_numpy(bool)
    low, high = np.searchsorted(pos, pos - window, "left").tolist(), np.searchsorted(pos, pos + window, "right").tolist()
    key = np.where(np.isnan(score), np.inf, -score).tolist()
    claimed = np.zeros(len(pos), bool)
    index, members, values = [], [np.zeros(0, np.int64)], [np.zeros(0)]
    for v in sorted(np.flatnonzero(lead).tolist(), key=lambda i: (key[i], ids[i])):
        if claimed[v]:
            continue
        a, b = low[v], high[v]
        r2 = link(np.abs(pos[a:b] - pos[v]))
        linked = member[a:b] & (r2 >= least_r2)
        linked[v - a], r2[v - a] = True, 1.0
        if exclusive:
            linked &= ~claimed[a:b]
        got = np.flatnonzero(linked)
        index.append((v, len(got)))
        members.append(got + a)
        values.append(r2[got])
        claimed[a:b] |= linked if exclusive else linked & lead[a:b]
    at = np.concatenate(members)
    out = pd.DataFrame({"index_id": np.repeat(ids[[v for v, _ in index]], [n for _, n in index]) if index else ids[:0], "member": ids[at], "r2": np.concatenate(values)})
    out["chrom"], out["pos"] = pdf["chrom"].iloc[0], pos[at]
    out["score"] = pdf["score"].array[at]
    return out


def clumps_by_distance(variants: DataFrame, link: Callable[[np.ndarray], np.ndarray], identifier: str, chrom: str, pos: str, lp: str, lead_lp: float, candidate_lp: float, least_r2: float = 0.6, window: int = 250_000, exclusive: bool = False, leads_a_block: int = 5000, most_blocks: int = 4096) -> DataFrame:
    """The clumps of `clumps`, where link gives r2 for an array of distances: index_id, member, r2, chrom, and the member's pos and score.

    No edge is listed: candidates move once, to the block of positions in which their island
    begins (or one before, if theirs reaches into it), and partners are looked up by position.
    Identifiers are unique; variants without a place are linked with nothing.
    """
    score = F.col(lp)
    d = variants.filter(F.col(identifier).isNotNull()).select(F.col(identifier).alias("id"), F.col(chrom).alias("chrom"), F.col(pos).alias("pos"), score.cast("double").alias("score"), F.coalesce(score >= lead_lp, F.lit(False)).alias("lead"), (score.isNull() | (score >= candidate_lp)).alias("member"))
    placed, types = F.col("chrom").isNotNull() & F.col("pos").isNotNull(), dict(d.dtypes)
    width, blocks = _blocks(d.filter(placed & F.col("lead")), "chrom", "pos", window, leads_a_block, most_blocks)
    met = (F.col("chrom") == F.col("__bc")) & (F.floor(F.col("pos") / F.lit(width)) == F.col("__bb"))
    dealt = d.filter(placed & (F.col("lead") | F.col("member"))).join(F.broadcast(blocks), met)
    dealt = dealt.withColumn("block", F.when(F.col("pos") >= F.col("__from"), F.col("__bb")).otherwise(F.col("__before"))).filter("block is not null")
    dealt = dealt.select("chrom", "block", "id", "pos", "score", "lead", "member")
    schema = f"index_id {types['id']}, member {types['id']}, r2 double, chrom {types['chrom']}, pos {types['pos']}, score double"
    out = dealt.groupBy("chrom", "block").applyInPandas(lambda pdf: _walk_places(pdf, link, least_r2, window, exclusive), schema)
    alone = d.filter(~placed & F.col("lead")).select(F.col("id").alias("index_id"), F.col("id").alias("member"), F.lit(1.0).alias("r2"), "chrom", "pos", "score")
    return out.unionByName(alone)


def best_parent(clumped: DataFrame) -> DataFrame:
    """Each member's index of greatest r2 (then least id), and all its indexes."""
    got = clumped.groupBy("member").agg(F.min(F.struct((-F.col("r2")).alias("r"), "index_id")).alias("x"), F.array_sort(F.collect_set("index_id")).alias("indexes"))
    return got.select("member", F.col("x.index_id").alias("parent"), (-F.col("x.r")).alias("r2"), "indexes")


def hubs(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Nodes by degree."""
    return edges.select(F.col(a).alias("node")).unionAll(edges.select(F.col(b).alias("node"))).groupBy("node").agg(F.count("*").alias("degree"))


def manhattan(df: DataFrame, chrom: str, pos: str, order: str) -> DataFrame:
    """Points on one axis: the lengths of all chromosomes before, plus the position."""
    sizes = df.groupBy(F.col(chrom).alias("__c"), F.col(order).alias("__o")).agg(F.max(pos).alias("__len"))
    before = F.coalesce(F.sum("__len").over(Window.orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("__off", before).select("__c", "__off")
    return df.join(F.broadcast(sizes), F.col(chrom) == F.col("__c")).withColumn("axis", F.col("__off") + F.col(pos)).drop("__c", "__off")


def dependency_order(targets: Iterable[str], needs: dict[str, Iterable[str]]) -> list[str]:
    """Targets and all they need, each after what it needs; a cycle is an error."""
    done: list[str] = []
    state: dict[str, int] = {}
    for target in targets:
        stack = [(target, iter(sorted(needs.get(target, ()))))]
        if state.get(target):
            continue
        state[target] = 1
        while stack:
            node, rest = stack[-1]
            nxt = next(rest, None)
            if nxt is None:
                stack.pop()
                state[node] = 2
                done.append(node)
            elif state.get(nxt) == 1:
                raise ValueError(f"cycle through {nxt}")
            elif nxt not in state:
                if nxt not in needs:
                    raise ValueError(f"unknown: {nxt}")
                state[nxt] = 1
                stack.append((nxt, iter(sorted(needs[nxt]))))
    return done

"""Near-duplicate documents by bottom-k sketches from one hash function.

1. One pass hashes every word shingle, takes the distinct hashes of a document (its set), the set's
   digest and its bottom-k sketch. Documents with equal sets form a class; the rest works on classes.
2. Inverted lists of the retained values give overlaps. Two sets similar enough share at least
   OVERLAP of K retained values (all but 1 in 10 million such pairs at the very threshold, all of
   those whose sets are small enough to be retained whole), so each class needs to be listed under
   all but its OVERLAP - 1 most frequent values; that keeps lists of common lines and passages
   from gathering unrelated documents.
3. Of each list the least class is the pivot. All others are compared with it, many pivots and
   many members of one in tasks of their own; what is linked gets one label. That is as much work
   as the lists have rows, and settles most groups of near copies, however large.
4. Lists in which different labels are left join their labels to candidate components. A
   component's members are dealt to blocks, and each pair of blocks is a task, except two blocks of
   one label. Blocks hold twice the root of the members, so that tasks grow as members do, up to
   MOST_MEMBERS a block. In a task pairs of one label are skipped; it emits fewer links than it has
   labels.

Pairs are compared alike in 3 and 4: enough overlap of the sketches, enough similarity by the
sketch of the union, then the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, components, join_groups, lean, located, without, written

#: Retained values and the least overlap of two sets similar enough: 64 draws at 0.8 give 32 or fewer in 1 of 10 million cases.
K, OVERLAP = 64, 33
#: Values of the union's sketch and the least share of common ones that is verified, chosen likewise.
UNION_K, UNION_FLOOR = 128, 72 / 128
#: Members of a block: at least, at most; shingles of a block; a task has two blocks.
LEAST_MEMBERS, MOST_MEMBERS, MOST_SHINGLES = 64, 2_048, 2_000_000
#: Members that one task compares with a pivot.
PIVOT_MEMBERS = 64
#: Classes in candidate components up to this number are broadcast to pick their texts; more are joined by shuffle.
MOST_BROADCAST = 400_000

MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles, A-Z lowered; of the whole sequence if it is shorter."""
    from xxhash import xxh3_64_intdigest

    got = text.lower().split()  # bytes: ASCII white space alone
    if not got:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, got), np.uint64, len(got))
    size = min(words, len(got))
    n = len(got) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += h[i : i + n] * (MULTIPLY[i % len(MULTIPLY)] + np.uint64(2 * (i // len(MULTIPLY))))
    return np.unique(mixed(total))


def least_overlap(n: int, percent: int, k: int = K) -> int:
    """Of its retained values, how many a set of n shares with any set similar enough."""
    return -(-n * percent // 100) if n * 100 <= k * percent else OVERLAP


def _sketches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ns, digests, sketches = [], [], []
            for t in b.column("__bytes"):
                s = shingle_set(t.as_py() or b"", words)
                ns.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sketches.append(s[:K].view(np.int64))
            offsets = np.cumsum([0, *map(len, sketches)]).astype(np.int32)
            flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
            kept = [n for n in b.schema.names if n != "__bytes"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*kept, "n", "digest", "sketch"])

    return run


def enough(sets: list[np.ndarray], a: np.ndarray, percent: int) -> list[bool]:
    """Which sets the union's sketch and then all values find similar enough to a; all are sorted."""
    if not sets:
        return []
    both = np.full((len(sets), 2 * UNION_K), np.iinfo(np.uint64).max, np.uint64)
    both[:, : min(UNION_K, len(a))] = a[:UNION_K]
    for row, s in zip(both, sets):
        row[UNION_K : UNION_K + min(UNION_K, len(s))] = s[:UNION_K]
    both.sort(1)
    valid = both != np.iinfo(np.uint64).max
    again = np.zeros_like(valid)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & valid[:, 1:]
    rank = np.cumsum(valid & ~again, 1)
    likely = (again & (rank <= UNION_K)).sum(1) >= UNION_FLOOR * np.minimum(rank[:, -1], UNION_K)

    def verified(s: np.ndarray) -> bool:
        met = len(np.intersect1d(a, s, assume_unique=True))
        return 100 * met >= percent * (len(a) + len(s) - met)

    return [bool(x) and verified(s) for x, s in zip(likely, sets)]


def links(sets: list[np.ndarray], percent: int, label: np.ndarray | None = None) -> np.ndarray:
    """A label for each set, the same for connected ones; sets of one label are connected to begin with."""
    m = len(sets)
    label = np.arange(m) if label is None else np.unique(label, return_inverse=True)[1]
    size = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(size, kind="stable")
    least = np.array([least_overlap(int(n), percent) for n in size])
    held = [s[:K] for s in sets]
    flat = np.concatenate(held)
    owner = np.repeat(np.arange(m), [len(x) for x in held])
    by = np.argsort(flat, kind="stable")
    flat, owner = flat[by], owner[by]
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    for a in order:
        lo, hi = np.searchsorted(flat, held[a], "left"), np.searchsorted(flat, held[a], "right")
        listed = np.concatenate([owner[x:y] for x, y in zip(lo, hi)])
        overlap = np.bincount(listed, minlength=m)
        near = np.flatnonzero((overlap >= least[a]) & (overlap >= least) & (place < place[a]) & (size * 100 >= size[a] * percent) & (label != label[a]))
        near = near[np.argsort(-overlap[near], kind="stable")]
        step = 16
        while len(near):
            some, near = near[:step], near[step:]
            step *= 8
            for j, same in zip(some, enough([sets[j] for j in some], sets[a], percent)):
                if same and label[j] != label[a]:
                    label[label == label[a]] = label[j]
            near = near[label[near] != label[a]]
    return label


def _pivots(words: int, percent: int):
    """Rows (key, member, cid, text), sorted, of each key the pivot first, to links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = pivot = pivot_set = None
        for b in batches:
            a, to = [], []
            for k, member, cid, text in zip(*(c.to_pylist() for c in b.columns)):
                mine = shingle_set(text or b"", words)
                if k != key:
                    if member:
                        raise ValueError(f"{k} has no pivot")
                    key, pivot, pivot_set = k, cid, mine
                elif member:
                    overlap = len(np.intersect1d(pivot_set[:K], mine[:K], assume_unique=True))
                    if overlap >= max(least_overlap(len(x), percent) for x in (pivot_set, mine)) and enough([mine], pivot_set, percent)[0]:
                        a.append(cid)
                        to.append(pivot)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(to, pa.int64())], ["a", "b"])

    return run


def _blocks(words: int, percent: int):
    """Rows (key, label, text), sorted by key, to links (a, b) between labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list) -> pa.RecordBatch:
            label = np.array([r[0] for r in rows], np.int64)
            group = links([shingle_set(r[1], words) for r in rows], percent, label)
            low = np.full(len(rows), np.iinfo(np.int64).max)
            np.minimum.at(low, group, label)
            pairs = np.unique(np.stack([label, low[group]], 1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        key, rows = None, []
        for b in batches:
            for k, label, text in zip(*(c.to_pylist() for c in b.columns)):
                if k != key and rows:
                    yield solved(rows)
                    rows = []
                key = k
                rows.append((label, text or b""))
        if rows:
            yield solved(rows)

    return run


def _lists(classes: DataFrame, percent: int) -> DataFrame:
    """The inverted lists that have more than one class: v, cid, pivot (the list's least cid), m (its length)."""
    spark = classes.sparkSession
    listed = classes.filter("n > 0").select("cid", "n", F.explode("sketch").alias("v"))
    counts = written(spark, listed.groupBy("v").agg(F.count("*").alias("f")).filter("f > 1"), "values", numbers=True)
    total = classes.agg(F.sum(F.size("sketch"))).first()[0] or 0
    # a common line's value is in many rows: those are broadcast, being few
    hot = max(2, int(total * HOT_SHARE))
    common = F.broadcast(counts.filter(F.col("f") >= hot))
    met = listed.join(common, "v").unionByName(listed.join(common.select("v"), "v", "left_anti").join(counts.filter(F.col("f") < hot), "v"))
    small = F.col("n") * 100 <= K * percent
    least = F.when(small, F.ceil(F.col("n") * percent / 100)).otherwise(OVERLAP)
    ranked = met.withColumn("r", F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("f"), "v")))
    lists = written(spark, ranked.filter(F.col("r") >= least).select("v", "cid"), "lists", small=True)
    first = lists.groupBy("v").agg(F.min("cid").alias("pivot"), F.count("*").alias("__n")).filter("__n > 1").withColumn("m", F.col("__n"))
    return written(spark, join_groups(lists, first, "v", lists.count(), ["pivot", "m"]).filter("m is not null"), "lists", small=True)


def _texts(slim: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (with a cid) and the text of each one's class as __bytes."""
    spark = slim.sparkSession
    places = classes.select(F.col("cid").alias("c"), F.col("keep.f").alias("mf"), F.col("keep.row").alias("mr"))
    rows = written(spark, rows.join(places, F.col("cid") == F.col("c")).drop("c"), "members", small=True)
    if rows.count() <= MOST_BROADCAST:
        rows = F.broadcast(rows)
    return slim.select("f", "row", "__bytes").join(rows, (F.col("f") == F.col("mf")) & (F.col("row") == F.col("mr"))).drop("f", "row", "mf", "mr")


def _by_pivots(slim: DataFrame, classes: DataFrame, lists: DataFrame, words: int, percent: int) -> DataFrame:
    """Labels of classes linked with pivots: node, component."""
    spark = slim.sparkSession
    pairs = written(spark, lists.filter("cid <> pivot").select("pivot", "cid").distinct(), "pairs", small=True)
    each = pairs.groupBy("pivot").agg(F.count("*").alias("__n")).withColumn("parts", F.ceil(F.col("__n") / PIVOT_MEMBERS))
    dealt = join_groups(pairs, each, "pivot", pairs.count(), ["parts"]).withColumn("key", F.concat_ws(":", "pivot", F.pmod(F.xxhash64("cid"), F.col("parts"))))
    dealt = written(spark, dealt.select("key", "pivot", "cid"), "dealt", small=True)
    rows = dealt.select("key", F.lit(1).alias("member"), "cid").unionByName(dealt.select("key", F.lit(0).alias("member"), F.col("pivot").alias("cid")).distinct())
    tasks = _texts(slim, classes, rows).select("key", "member", "cid", "__bytes").repartition("key").sortWithinPartitions("key", "member")
    found = written(spark, tasks.mapInArrow(lean(_pivots(words, percent)), "a long, b long"), "links", numbers=True)
    return written(spark, components(spark, found), "labels", small=True)


def _by_blocks(slim: DataFrame, classes: DataFrame, lists: DataFrame, labels: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between labels that lists leave open: node, component."""
    spark = slim.sparkSession
    # in a list of two the one pair has been compared; pivots have been compared with all of their list
    left = lists.filter("m > 2 and cid <> pivot").join(labels, F.col("cid") == F.col("node"), "left").select("v", "cid", F.coalesce("component", "cid").alias("label"))
    left = written(spark, left, "open", small=True)
    mixed = left.groupBy("v").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("__n")).filter("lo <> hi")
    left = written(spark, join_groups(left, mixed, "v", left.count(), ["lo"]).filter("lo is not null"), "open", small=True)
    near = written(spark, components(spark, left.select(F.col("label").alias("a"), F.col("lo").alias("b"))), "candidates", small=True)
    members = written(spark, left.select("cid", "label").distinct(), "open", small=True)
    sizes = members.join(classes.select(F.col("cid").alias("c"), "n"), F.col("cid") == F.col("c")).groupBy("label").agg(F.count("*").alias("k"), F.sum("n").alias("n")).withColumn("__n", F.col("k"))
    sizes = written(spark, sizes.join(near, F.col("label") == F.col("node")).select("component", "label", "k", "n", "__n"), "labels", small=True)
    # a label as large as a block has blocks of its own; all others of a component share some
    n_labels = sizes.count()
    wholes = sizes.groupBy("component").agg(F.sum("k").alias("whole"), F.count("*").alias("__n"))
    room = F.least(F.lit(MOST_MEMBERS), F.greatest(F.lit(LEAST_MEMBERS), F.ceil(2 * F.sqrt("whole")))).cast("long")
    roomy = join_groups(sizes.withColumnRenamed("__n", "members"), wholes, "component", n_labels, ["whole"]).withColumn("room", room)
    roomy = roomy.withColumn("own", F.when(F.col("k") >= F.col("room"), F.col("label"))).withColumn("home", F.concat_ws(":", "component", "own"))
    sizes = written(spark, roomy.select("component", "label", "k", "n", "members", "room", "own", "home"), "labels", small=True)
    parts = lambda k, n: F.greatest(F.ceil(k / F.col("room")), F.ceil(n / MOST_SHINGLES), F.lit(1)).cast("long")
    blocks = sizes.groupBy("home", "component", "own", "room").agg(F.sum("k").alias("k"), F.sum("n").alias("n"), F.count("*").alias("__n"))
    blocks = blocks.select("home", "__n", "component", "own", parts(F.col("k"), F.col("n")).alias("parts"))
    one = blocks.select("component", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("block"))
    a, b = (one.select(*[F.col(c).alias(x + c) for c in one.columns]) for x in "ab")
    before = F.struct(F.coalesce("aown", F.lit(-1)), "ablock") <= F.struct(F.coalesce("bown", F.lit(-1)), "bblock")
    pairs = a.join(b, (F.col("acomponent") == F.col("bcomponent")) & before).filter("aown is null or bown is null or aown <> bown")
    key = F.concat_ws(":", "acomponent", F.coalesce("aown", F.lit(-1)), "ablock", F.coalesce("bown", F.lit(-1)), "bblock")
    pairs = pairs.select(key.alias("key"), *a.columns, *b.columns)
    sides = [pairs.select("key", *[F.col(x + c).alias("t" + c) for c in one.columns]) for x in "ab"]
    tasks = written(spark, sides[0].union(sides[1]).distinct(), "tasks", small=True)
    # a member's block
    where = join_groups(sizes, blocks, "home", n_labels, ["parts"]).select("label", "component", "own", "parts", F.col("members").alias("__n"))
    put = join_groups(members, where, "label", members.count(), ["component", "own", "parts"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("parts")))
    same = (F.col("component") == F.col("tcomponent")) & (F.col("block") == F.col("tblock")) & F.col("own").eqNullSafe(F.col("town"))
    rows = put.join(tasks, same).select("key", "label", "cid")
    texts = _texts(slim, classes, rows).select("key", "label", "__bytes").repartition("key").sortWithinPartitions("key")
    found = written(spark, texts.mapInArrow(lean(_blocks(words, percent)), "a long, b long"), "links", numbers=True)
    return written(spark, components(spark, found), "labels", small=True)


def _decisions(placed: DataFrame, file: str, at: str, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n, keep (struct of the row that stays: nul, doc_id, file, row), f, row."""
    spark = placed.sparkSession
    slim = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(file).alias("f"), F.col(at).alias("row"), F.col("text").cast("string").cast("binary").alias("__bytes"))
    docs = written(spark, slim.mapInArrow(lean(_sketches(words)), "doc_id long, f long, row long, n long, digest binary, sketch array<long>"), "sketches", numbers=True)
    total = docs.count()
    who = F.struct(F.col("doc_id").isNull().alias("nul"), "doc_id", "f", "row")
    classes = docs.filter("n > 0").groupBy("digest").agg(F.min(who).alias("keep"), F.max("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    classes = written(spark, classes.withColumn("cid", F.monotonically_increasing_id()), "classes", numbers=True)
    lists = _lists(classes, percent)
    labels = _by_pivots(slim, classes, lists, words, percent)
    merged = _by_blocks(slim, classes, lists, labels, words, percent).select(F.col("node").alias("l"), F.col("component").alias("top"))
    groups = classes.select("digest", "cid", "keep", "copies").join(labels, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("component", "cid"))
    groups = groups.join(merged, F.col("label") == F.col("l"), "left").withColumn("root", F.coalesce("top", "label"))
    keeps = groups.groupBy("root").agg(F.min("keep").alias("kept"), F.count("*").alias("m"), F.sum("copies").alias("group"))
    keeps = keeps.filter("m > 1").select(F.col("root").alias("r"), "kept", "group")
    groups = groups.join(keeps, F.col("root") == F.col("r"), "left").filter("copies > 1 or r is not null")
    groups = groups.select(F.col("digest").alias("g"), F.col("copies").alias("__n"), F.coalesce("kept", "keep").alias("keep"))
    groups = groups.withColumn("g", F.hex("g"))
    rows = docs.select("doc_id", "f", "row", "n", F.when(F.col("n") > 0, F.hex("digest")).otherwise(F.concat(F.lit("-"), F.col("f"), F.lit("-"), F.col("row"))).alias("g"))
    rows = join_groups(rows, groups, "g", total, ["keep"])
    return rows.select("doc_id", "n", F.coalesce("keep", who).alias("keep"), "f", "row")


def decisions(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets.
    component_id is the smallest doc_id reachable; kept means it is the row's own. Null or empty
    text has no shingles and is linked with nothing. A null doc_id counts as larger than all.
    Repeated rows are copies. No rows give no rows.
    """
    rows = _decisions(*located(docs.sparkSession, docs), words, percent)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("keep.doc_id").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("keep.doc_id")).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, whole, whatever their columns are called: of each group of near-duplicates
    the one with the smallest doc_id (nulls last; of rows that repeat it, the one stored first by file and row).
    Null and empty texts are in no group: their rows all stay."""
    placed = located(docs.sparkSession, docs)
    rows = _decisions(*placed, words, percent)
    return without(*placed, rows.filter((F.col("keep.f") != F.col("f")) | (F.col("keep.row") != F.col("row"))).select("f", "row"))

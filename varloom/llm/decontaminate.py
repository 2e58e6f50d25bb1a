"""Benchmark passages in documents, by the q-gram lemma.

An item of m characters that lies in a text with at most k edits shares at least
m - Q + 1 - Q * k of its q-grams with it, on diagonals (text position less item position) that lie
within k of each other. So shared q-grams are counted in diagonal bands of width 2 * s, s > k, each
overlapping the next by half; bands that reach the bound are verified by banded alignment. Items
and texts are compared in lower case with white space runs as one space.

The benchmark is the stated query set: it goes to the executors in blocks of bounded size, each
broadcast in turn against all documents. Documents aren't shuffled.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, located, table, text_of, without, written

Q = 10
#: Edits allowed for each character of an item.
EDIT_RATE = 0.06
#: Characters of benchmark items that are broadcast at once.
BLOCK_CHARS = 4_000_000
#: Hash bits of the first test of a q-gram, and characters of text tested at once.
FILTER_BITS, TEXT_CHARS = 20, 1_000_000
#: Shared q-grams listed at once.
MOST_SHARED = 400_000
#: Regions aligned at once.
MOST_ALIGNED = 512

WORD = re.compile(r"\S+")


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def grams(c: np.ndarray) -> np.ndarray:
    """A hash of each Q characters."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    m = np.uint64(0x9E3779B97F4A7C15)
    g2 = c[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[1:]
    g4 = g2[:-2] * m + g2[2:]
    g8 = g4[:-4] * m + g4[4:]
    n = len(c) - Q + 1
    h = g8[:n] * m + g2[8 : 8 + n]
    h = (h ^ (h >> np.uint64(32))) * m
    return h ^ (h >> np.uint64(29))


def budget(m: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed, few enough for the bound to stay positive."""
    return max(0, min(int(m * rate), (m - Q) // Q))


class Index:
    """The q-grams of a block of items (item_id, text); items shorter than Q have none and are left out."""

    def __init__(self, items: list[tuple[int, str]], rate: float = EDIT_RATE):
        self.items = [(i, t) for i, t in ((i, normal(t or "")) for i, t in items) if len(t) >= Q]
        lengths = np.array([len(t) for _, t in self.items], np.int64)
        self.edits = np.array([budget(int(m), rate) for m in lengths], np.int64)
        self.least = lengths - Q + 1 - Q * self.edits
        self.half = self.edits + 1
        all_grams = [grams(codes(t)) for _, t in self.items]
        flat = np.concatenate([*all_grams, np.zeros(0, np.uint64)])
        by = np.argsort(flat, kind="stable")
        self.hashes = flat[by]
        self.item = np.repeat(np.arange(len(self.items)), [len(g) for g in all_grams])[by]
        self.place = np.concatenate([*[np.arange(len(g)) for g in all_grams], np.zeros(0, np.int64)]).astype(np.int64)[by]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def regions(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first diagonal, last diagonal) of the bands that reach the bound; texts are normal.

        Shared q-grams are counted before they are listed: texts go together as long as all theirs
        are at most MOST_SHARED; a text that alone has more is counted in slices of so many.
        """
        if not len(self.hashes):
            return
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        h = grams(codes("\0".join(texts)))
        at = np.flatnonzero(self.maybe[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        lo = np.searchsorted(self.hashes, h[at], "left")
        n = np.searchsorted(self.hashes, h[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        text = np.searchsorted(starts, at, "right") - 1
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        upto = np.concatenate([[0], np.cumsum(n)])
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(upto[edge], upto[edge[first]] + MOST_SHARED, "right")) - 1)
            some = slice(edge[first], edge[last])
            if upto[edge[last]] - upto[edge[first]] > MOST_SHARED:
                yield from self._of_one(first, h[at[some]], at[some] - starts[first], lo[some], n[some])
            elif some.start < some.stop:
                yield from self._of_all(text[some], at[some] - starts[text[some]], lo[some], n[some])
            first = last

    def _of_all(self, text: np.ndarray, place: np.ndarray, lo: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        entry = listed(lo, n)
        text, item = np.repeat(text, n), self.item[entry]
        band = (np.repeat(place, n) - self.place[entry]) // self.half[item]
        key = np.stack([np.concatenate([text, text]), np.concatenate([item, item]), np.concatenate([band, band - 1])])
        by = np.lexsort(key[::-1])
        key = key[:, by]
        edge = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
        count = np.diff(np.append(edge, key.shape[1]))
        key = key[:, edge]
        for t, i, b in key[:, count >= self.least[key[1]]].T.tolist():
            yield t, i, b * int(self.half[i]), (b + 2) * int(self.half[i]) - 1

    def _of_one(self, text: int, h: np.ndarray, place: np.ndarray, lo: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Items with enough shared q-grams in all, then each one's bands."""
        counts = np.zeros(len(self.items), np.int64)
        for some in slices(n):
            counts += np.bincount(self.item[listed(lo[some], n[some])], minlength=len(self.items))
        for i in np.flatnonzero(counts >= self.least).tolist():
            mine = np.sort(own := grams(codes(self.items[i][1])))
            order, half = np.argsort(own, kind="stable"), int(self.half[i])
            a = np.searchsorted(mine, h, "left")
            m = np.searchsorted(mine, h, "right") - a
            hits, a, m = place[m > 0], a[m > 0], m[m > 0]
            least = -(len(own) // half) - 2
            bands = np.zeros(int(hits[-1]) // half - least + 3, np.int64)
            for some in slices(m):
                band = (np.repeat(hits[some], m[some]) - order[listed(a[some], m[some])]) // half - least
                bands += np.bincount(band, minlength=len(bands))
            bands[:-1] += bands[1:].copy()  # band b holds b and b + 1
            for b in (np.flatnonzero(bands >= self.least[i]) + least).tolist():
                yield text, i, b * half, (b + 2) * half - 1


def listed(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... n[0] of them, then those from lo[1] on."""
    upto = np.cumsum(n)
    return np.repeat(lo - (upto - n), n) + np.arange(int(upto[-1]) if len(n) else 0)


def slices(n: np.ndarray, most: int | None = None) -> Iterator[slice]:
    """Slices of n whose sums are at most `most`, or of one element."""
    most = most or MOST_SHARED
    upto, at = np.concatenate([[0], np.cumsum(n)]), 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        yield slice(at, end)
        at = end


def aligned(cases: list[tuple[str, str, int, int, int]]) -> list[tuple[int, int, int] | None]:
    """For each (item, text, first, last, most): (start, end, edits) of the best place of item in text
    within diagonals first..last, if it takes at most `most` edits."""
    out: list[tuple[int, int, int] | None] = [None] * len(cases)
    rest = []
    for k, (item, text, first, last, most) in enumerate(cases):
        lo, hi = max(0, first - most), min(len(text), last + len(item) + most)
        at = text.find(item, lo, hi)
        if at >= 0:
            out[k] = at, at + len(item), 0
        elif most:
            rest.append((k, lo, hi))
    pairs = [(cases[k][0], cases[k][1][lo:hi], cases[k][2] - cases[k][4] - lo, cases[k][3] + cases[k][4] - lo, cases[k][4]) for k, lo, hi in rest]
    for (k, lo, _), end in zip(rest, _ends(pairs)):
        if end is not None:
            item, text, _, _, most = cases[k]
            stop, edits = end
            part = text[max(lo, lo + stop - len(item) - most) : lo + stop]
            # from the end backwards: the item reversed starts where the part reversed does
            back = _ends([(item[::-1], part[::-1], -most, most, most)], anchored=True)[0]
            out[k] = lo + stop - (back[0] if back else len(item)), lo + stop, edits
    return out


def _ends(cases: list[tuple[str, str, int, int, int]], anchored: bool = False) -> list[tuple[int, int] | None]:
    """For each (p, t, first, last, most): end in t and edits of the cheapest alignment of p over diagonals
    first..last, if it has at most `most`; anchored: it starts at 0. All go a row at a time together."""
    out: list[tuple[int, int] | None] = [None] * len(cases)
    if not cases:
        return out
    far = 1 << 20
    ps, ts = [codes(c[0]) for c in cases], [codes(c[1]) for c in cases]
    m, n = np.array([len(p) for p in ps]), np.array([len(t) for t in ts])
    flat_p, flat_t = np.concatenate(ps), np.concatenate([*ts, np.zeros(1, np.uint64)])
    at_p, at_t = np.cumsum(m) - m, np.cumsum(n) - n
    first, last, most = (np.array([c[k] for c in cases]) for k in (2, 3, 4))
    wide = np.arange(int((last - first).max()) + 1)
    d = first[:, None] + wide
    there = d <= last[:, None]
    row = np.where(there & (d >= 0) & (d <= n[:, None]), np.abs(d) if anchored else 0, far)
    who, i = np.arange(len(cases)), 0
    while len(who):
        i += 1
        j = d + i
        ok = there & (j >= 1) & (j <= n[who][:, None])
        same = flat_t[np.where(ok, at_t[who][:, None] + j - 1, 0)] == flat_p[at_p[who] + i - 1][:, None]
        new = np.where(ok, row + ~same, far)
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        inside = there & (j >= 0) & (j <= n[who][:, None])
        new = np.where(inside, new, far)
        row = np.where(inside, np.minimum.accumulate(new - d, 1) + d, far)
        best = row.argmin(1)
        least = row[np.arange(len(who)), best]
        for x in np.flatnonzero((m[who] == i) & (least <= most[who])).tolist():
            out[who[x]] = int(d[x, best[x]]) + i, int(least[x])
        on = (m[who] > i) & (least <= most[who])  # a row's least only grows
        if not on.all():
            who, d, there, row = who[on], d[on], there[on], row[on]
    return out


def original(text: str, start: int, end: int) -> tuple[int, int]:
    """Where start and end of the normal text lie in the text itself."""
    at, places, words = 0, [], []
    for m in WORD.finditer(text):
        places.append(at)
        words.append((m.start(), m.end()))
        at += len(m[0].lower()) + 1

    def back(x: int, is_end: bool) -> int:
        k = max(0, bisect_right(places, x - is_end) - 1)
        s, e = words[k]
        return min(e, s + x - places[k])

    return back(start, False), back(end, True)


def matches(index: Index, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item_id, start, end, edits) of the items found, each place once."""
    normals = [normal(t) for t in texts]
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(normals[stop]) < TEXT_CHARS):
            size += len(normals[stop])
            stop += 1
        done: dict[tuple[int, int], list[tuple[int, int]]] = {}
        regions = index.regions(normals[at:stop])
        while some := list(itertools.islice(regions, MOST_ALIGNED)):
            cases = [(index.items[i][1], normals[at + t], first, last, int(index.edits[i])) for t, i, first, last in some]
            for (t, i, _, _), got in zip(some, aligned(cases)):
                spans = done.setdefault((t, i), [])
                if got and not any(got[0] < e and s < got[1] for s, e in spans):
                    spans.append(got[:2])
                    yield at + t, index.items[i][0], *original(texts[at + t], *got[:2]), got[2]
        at = stop


def _found(placed: DataFrame, file: str, at: str, benchmark: DataFrame, rate: float) -> DataFrame:
    """Rows (doc_id, item_id, start, end, edits, f, row) of a located frame."""
    spark = placed.sparkSession
    schema = "doc_id long, f long, row long, item_id long, start long, end long, edits long"
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    slim = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(file).alias("f"), F.col(at).alias("row"), text_of("text").alias("text"))
    out = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = spark.sparkContext.broadcast(Index(sorted(((i, t) for i, t in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])), rate))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = b.column(3).to_pylist()
                got = list(matches(index.value, texts))
                at = pa.array([g[0] for g in got], pa.int64())
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in range(3)], *[pa.array([g[c] for g in got], pa.int64()) for c in range(1, 5)]], [f.split()[0] for f in schema.split(", ")])

        rows = written(spark, slim.mapInArrow(lean(run), schema), "leaks")
        out = rows if out is None else out.unionByName(rows)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """A row per place where an item lies in a document: doc_id, item_id, start, end, edits.

    start and end are code points of the document's own text. Null or empty texts hold nothing;
    null, empty or very short items (under Q characters) are not looked for. Null ids stay null;
    repeated rows are reported each. Documents without matches have no row.
    """
    return _found(*located(docs.sparkSession, docs), benchmark, rate).drop("f", "row")


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns, whatever those are called.

    Null and empty texts hold none and stay; repeated rows stay or go together. An empty benchmark drops nothing.
    """
    placed = located(docs.sparkSession, docs)
    return without(*placed, _found(*placed, benchmark, rate).select("f", "row").distinct())


def benchmark_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", "text")

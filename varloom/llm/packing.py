"""Sum-of-squares online packing of documents into fixed windows of tokens.

Each document's ids are cut into full windows; its remainder goes where the sum of the squared
counts of partially filled windows, kept in a level array, becomes least. What stays open at the
end of a task is joined by cutting, and the last rest is cut into sequences whose lengths are
powers of two, which need no padding. If too many are open, the fuller half is joined so; the
others stay in the level array.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lean, written
from .tokens import gathered, shared_tokenizer

WINDOW = 2048
#: Windows open at most; beyond that the fuller half is joined. Bounds a task's memory.
MOST_OPEN = 2048
#: Words that a worker keeps the ids of.
MOST_WORDS = 300_000
#: Sequence ids of a task start at its partition times this.
IDS_PER_TASK = 1 << 40

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class SumOfSquares:
    """place(size): the level a piece of that size goes on, 0 for a new window."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)

    def place(self, size: int) -> int:
        n, w = self.counts, self.window
        n[0] = n[w] = 0
        # from level h to h + size the sum of squares changes by 2 (n[h + size] - n[h] + 1), less at either end
        change = 2 * (n[size : w + 1] - n[: w + 1 - size] + 1)
        change[0] = 2 * n[size] + 1
        change[-1] = 1 - 2 * n[w - size] if size < w else 0
        change[1:][n[1 : w + 1 - size] == 0] = np.iinfo(np.int64).max
        level = int(change.argmin())
        if level:
            n[level] -= 1
        if level + size < w:
            n[level + size] += 1
        return level


def pack(docs: Iterator[tuple[int, bytes]], first_id: int, window: int = WINDOW, most_open: int = MOST_OPEN) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, crc, doc_tokens, sequence_id, offset) of (doc_id, packed ids)."""
    squares, next_id, n_open = SumOfSquares(window), first_id, 0
    level_of: dict[int, list] = {}  # level -> open windows, each a list of (doc_id, start, raw, doc_tokens)

    def row(piece: tuple, sequence: int, offset: int) -> tuple:
        doc_id, start, raw, total = piece
        return doc_id, start, len(raw) // 4, zlib.crc32(raw), total, sequence, offset

    def closed(pieces: list, sequence: int) -> Iterator[tuple]:
        offset = 0
        for p in pieces:
            yield row(p, sequence, offset)
            offset += len(p[2]) // 4

    def joined(windows: list[list], last: bool) -> Iterator[tuple]:
        """Join windows by cutting: full ones; the rest is cut into powers of two if it is the last, else stays open."""
        nonlocal next_id, n_open
        pieces = [p for w in windows for p in w]
        left = sum(len(p[2]) // 4 for p in pieces)
        queue, at = iter(pieces), None
        while left >= window or last and left:
            size = window if left >= window else 1 << (left.bit_length() - 1)
            offset = 0
            while offset < size:
                at = at or next(queue)
                doc_id, start, raw, total = at
                take = min(size - offset, len(raw) // 4)
                yield row((doc_id, start, raw[: take * 4], total), next_id, offset)
                at = (doc_id, start + take, raw[take * 4 :], total) if take * 4 < len(raw) else None
                offset += take
            left -= size
            next_id += 1
        if left:
            level_of.setdefault(left, []).append(([at] if at else []) + list(queue))
            squares.counts[left] += 1
            n_open += 1

    def fullest(n: int) -> list[list]:
        """Take the n fullest windows out of the array."""
        nonlocal n_open
        out: list[list] = []
        for level in sorted(level_of, reverse=True):
            while level_of[level] and len(out) < n:
                out.append(level_of[level].pop())
                squares.counts[level] -= 1
        n_open -= len(out)
        return out

    for doc_id, raw in docs:
        total = len(raw) // 4
        whole = total - total % window
        for start in range(0, whole, window):
            yield row((doc_id, start, raw[start * 4 : (start + window) * 4], total), next_id, 0)
            next_id += 1
        if whole == total:
            continue
        size = total - whole
        level = squares.place(size)
        pieces = level_of[level].pop() if level else []
        n_open += not level
        pieces.append((doc_id, whole, raw[whole * 4 :], total))
        if level + size == window:
            yield from closed(pieces, next_id)
            next_id += 1
            n_open -= 1
        else:
            level_of.setdefault(level + size, []).append(pieces)
        if n_open > most_open:
            yield from joined(fullest(n_open // 2), False)
    yield from joined(fullest(n_open), True)


def packed(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """One row per piece of the documents (doc_id, text): see SCHEMA.

    Null or empty text: its one id, end_id, is packed. Null doc_id stays null; repeated rows are
    packed each. Other columns are left out. No rows give no rows. One pass over the input, with
    no shuffle: a task packs its own rows, so a retried task gives the same pieces. They are
    written here, as the size of batches that texts go to Python in is the session's where a plan
    is run: 10,000 texts, its default, are some 30 MB that JVM and worker both hold.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = shared_tokenizer(vocabulary, MOST_WORDS)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def docs_of() -> Iterator[tuple[int, bytes]]:
            for b in gathered(batches, 1024, 4 << 20):
                for doc_id, raw in zip(b.column(0).to_pylist(), tokenizer.ids(b.column(1))):
                    yield doc_id, raw + end

        rows = []
        for r in pack(docs_of(), TaskContext.get().partitionId() * IDS_PER_TASK, window):
            rows.append(r)
            if len(rows) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    pieces = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(lean(run), SCHEMA)
    return written(docs.sparkSession, pieces, "pieces", numbers=True)

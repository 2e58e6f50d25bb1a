"""Token ids in compact binary shards: Re-Pair grammars with random access.

A shard is one blob, little-endian throughout:

    magic b"VLRP", version u32, n_docs u64, n_rules u32, n_symbols u64, first_symbol u32,
    start u64                            ids of all shards before it
    doc_id i64[n_docs], null u8[n_docs], n_tokens u64[n_docs], ends u64[n_docs]
    rules symbols[2 * n_rules], lengths u64[n_rules], symbols symbols[n_symbols]

A symbol has as many bits as first_symbol + n_rules needs, 16 at least: a run of symbols is their
low 16 bits as u16, then for each higher bit a plane of all their bits, eight in a byte. Symbols
from first_symbol on are nonterminals; rule r's expansion has lengths[r] ids. ends holds, for
each document, where its symbols end: nonterminals never reach over a document's end, so one
document's ids are decoded from its own symbols. Blobs lie one a row in Parquet files, so that
Spark's own commit protocol covers them on any store and a lost executor leaves no half shard.
"""

from __future__ import annotations

import functools
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, lean, shared_dir
from .tokens import gathered, shared_tokenizer, spread

MAGIC, VERSION, HEAD = b"VLRP", 2, "<4sIQIQIQ"
#: Ids gathered for one shard; a longer document makes a longer shard.
SHARD_IDS = 1_000_000
#: A round takes pairs that occur at least this share as often as the most frequent one.
SHARE = 0.02
#: Bits of a number to sort by.
KEY_BITS = 64
#: A position's level while its pair is to be counted; else it is at most one less.
FRESH = 255
#: Sorts behind all pairs.
LAST_KEY = np.uint64(2**64 - 1)


def _counted(seq: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that start at `at`, grouped: each as one number of two symbols of so many bits, occurrences, all positions group by group, and those of equal ids.

    Of a run of equal ids every other position counts, so that occurrences don't overlap.
    """
    left, right = seq.take(at), seq[1:].take(at)
    twins = np.flatnonzero(left == right)
    equal = at[twins]
    begins, place = np.ones(len(twins), bool), np.arange(len(twins))
    np.not_equal(equal[1:], equal[:-1] + 1, out=begins[1:])
    out = twins[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 1]
    places = len(seq).bit_length()
    key = left.astype(np.uint64)
    key <<= np.uint64(bits)
    key |= right
    if 2 * bits + places <= KEY_BITS:  # pair and position in one number sort fastest
        key <<= np.uint64(places)
        key |= at.view(np.uint64)
        key[out] = LAST_KEY
        key.sort()
        key = key[: len(key) - len(out)]
        at = (key & np.uint64((1 << places) - 1)).view(np.int64)
        key >>= np.uint64(places)
    else:
        key[out] = LAST_KEY
        by = np.argsort(key, kind="stable")[: len(key) - len(out)]
        key, at = key[by], at[by]
    begins = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=begins[1:])
    edge = np.flatnonzero(begins)
    return key[edge], np.diff(np.append(edge, len(key))), at, equal


def compress(ids: np.ndarray, ends: np.ndarray, first: int, share: float = SHARE, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rules, expansion lengths, symbols and the documents' ends in them; all ids lie below first.

    Re-Pair in rounds, until no pair of neighbours in a document occurs twice. A round ranks the
    pairs that occur, without overlap, at least `share` as often as the most frequent one (ties:
    lesser left, then right). A symbol takes the side that it has in the first of them it is in;
    pairs both of whose symbols are on their sides can't overlap and are replaced at once, but at
    most the first `most` of them: 1 makes it Re-Pair's own order. A pair of equal ids is taken if
    it is the first that its symbol is in.

    No pair becomes more frequent but by a new symbol, all of whose pairs are counted. So `level`
    holds, for each position, how often its pair occurred when last counted, FRESH if it is to be
    counted again in any case, and a round counts only those that may be frequent enough for it.
    """
    rules: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    seq, ends = ids.astype(np.uint32), ends.astype(np.int64)
    next_symbol, span = first, np.ones(first, np.uint64)
    as_left = np.empty(first + len(seq) + 1, np.int64)
    as_right = as_left.copy()
    level, need = np.full(len(seq), FRESH, np.uint8), 2
    while True:
        level[ends[ends > 0] - 1] = 0
        bits, least, found = (next_symbol - 1).bit_length(), FRESH + 1, []
        while not found or need < least:  # the round before had more frequent ones: those in between
            below, least = least, min(need, FRESH - 1)
            due = level >= least
            if found:
                due &= level < below
            found.append(_counted(seq, np.flatnonzero(due), bits))
            top = max(int(f[1].max(initial=0)) for f in found)
            need = max(2, math.ceil(share * top))
        if top < 2:
            break
        pair, count, places, equal = found[0] if len(found) == 1 else map(np.concatenate, zip(*found))
        often = np.flatnonzero(count >= need)
        often = often[np.lexsort((pair[often], -count[often]))]
        left, right = (pair[often] >> np.uint64(bits)).astype(np.int64), (pair[often] & np.uint64((1 << bits) - 1)).astype(np.int64)
        rank = np.arange(len(often))
        as_left[left] = as_right[left] = as_left[right] = as_right[right] = len(often)
        as_left[left[::-1]], as_right[right[::-1]] = rank[::-1], rank[::-1]
        fits = np.where(left == right, (as_left[left] == rank) & (as_right[left] == rank), (as_left[left] < as_right[left]) & (as_right[right] < as_left[right]))
        taken = np.flatnonzero(fits)[:most]
        chosen = often[taken]
        n, starts = count[chosen], np.cumsum(count) - count
        upto = np.cumsum(n)
        hits = places[np.repeat(starts[chosen] - (upto - n), n) + np.arange(upto[-1])]
        level[places] = np.repeat(np.where(count < need, np.minimum(count, FRESH - 1), FRESH).astype(np.uint8), count)
        level[equal] = FRESH  # which of a run's positions count may change
        seq[hits] = np.repeat(np.arange(next_symbol, next_symbol + len(chosen), dtype=np.uint32), n)
        level[hits] = FRESH
        level[hits[hits > 0] - 1] = FRESH
        keep = np.ones(len(seq), bool)
        keep[hits + 1] = False
        stay = np.flatnonzero(keep)
        ends = np.searchsorted(stay, ends)
        seq, level = seq.take(stay), level.take(stay)
        rules.append(np.stack([left[taken], right[taken]], 1))
        lengths.append(span[rules[-1]].sum(1))
        span = np.concatenate([span, lengths[-1]])
        next_symbol += len(chosen)
    none = np.zeros((0, 2), np.int64)
    return np.concatenate([none, *rules]), np.concatenate([none[:, 0].astype(np.uint64), *lengths]), seq, ends


def packed_symbols(values: np.ndarray, bits: int) -> bytes:
    planes = [np.packbits((values >> k & 1).astype(np.uint8)).tobytes() for k in range(16, bits)]
    return b"".join([(values & 0xFFFF).astype("<u2").tobytes(), *planes])


def bits_of(first: int, n_rules: int) -> int:
    return max(16, (first + n_rules - 1).bit_length())


def encode_shard(doc_ids: list, counts: np.ndarray, ids: np.ndarray, start: int, first: int) -> bytes:
    """The blob of documents whose ids, all below first, follow each other in ids."""
    rules, lengths, symbols, ends = compress(ids, np.cumsum(counts), first)
    bits = bits_of(first, len(rules))
    return b"".join(
        [
            struct.pack(HEAD, MAGIC, VERSION, len(doc_ids), len(rules), len(symbols), first, start),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            counts.astype("<u8").tobytes(),
            ends.astype("<u8").tobytes(),
            packed_symbols(rules.ravel(), bits),
            lengths.astype("<u8").tobytes(),
            packed_symbols(symbols, bits),
        ]
    )


class Shard:
    """A blob's reader; ids(i) decodes document i alone, all() every document."""

    def __init__(self, blob: bytes):
        magic, version, n, n_rules, self.n_symbols, self.first, self.start = struct.unpack_from(HEAD, blob)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of this format")
        self.blob, self.bits = blob, bits_of(self.first, n_rules)
        at = struct.calcsize(HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, count, at)
            at += out.nbytes
            return out

        values, null = take("<i8", n), take("u1", n)
        self.doc_ids = [None if z else v for v, z in zip(values.tolist(), null.tolist())]
        self.counts, self.ends = take("<u8", n).astype(np.int64), take("<u8", n).astype(np.int64)
        self.rules = self._symbols(at, 2 * n_rules, 0, 2 * n_rules).reshape(-1, 2)
        at += 4 * n_rules + (self.bits - 16) * -(-2 * n_rules // 8)
        self.lengths = take("<u8", n_rules).astype(np.int64)
        self.at = at

    def _symbols(self, at: int, count: int, start: int, end: int) -> np.ndarray:
        """Symbols start to end of the count that lie packed from byte at on."""
        out = np.frombuffer(self.blob, "<u2", end - start, at + 2 * start).astype(np.int64)
        at, lo, hi = at + 2 * count, start // 8, -(-end // 8)
        for k in range(16, self.bits):
            plane = np.unpackbits(np.frombuffer(self.blob, np.uint8, hi - lo, at + lo))
            out |= plane[start - 8 * lo : end - 8 * lo].astype(np.int64) << k
            at += -(-count // 8)
        return out

    def symbols(self, start: int, end: int) -> np.ndarray:
        return self._symbols(self.at, self.n_symbols, start, end)

    @functools.cached_property
    def short(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Expansions one after the other, where each symbol's begins, each symbol's length, and the length up to which they are held.

        Together they have no more ids than the shard. Rules follow those that they are made of:
        each goes with all after it that name only rules before it.
        """
        size = np.concatenate([np.ones(self.first, np.int64), self.lengths])
        by_length = np.sort(size[self.first :])
        n = int(np.searchsorted(np.cumsum(by_length), self.counts.sum(), "right"))
        most = int(by_length[n]) - 1 if n < len(by_length) else int(size.max(initial=1))
        held = np.where(size <= most, size, 0)
        begin = np.cumsum(held) - held
        flat = np.empty(int(held.sum()), np.uint32)
        flat[: self.first] = np.arange(self.first)
        newest, i = np.maximum.accumulate(self.rules.max(1, initial=0)), 0
        while i < len(self.rules):
            j = int(np.searchsorted(newest, self.first + i))
            parts = self.rules[i:j][self.lengths[i:j] <= most].ravel()
            made = spread(flat, begin.take(parts), size.take(parts))
            flat[begin[self.first + i] :][: len(made)] = made
            i = j
        return flat, begin, size, most

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Long nonterminals one level down at a time in their places, then all others at once."""
        flat, begin, size, most = self.short
        while (long := size.take(symbols) > most).any():
            at = np.cumsum(1 + long)[long] - 2
            pair = self.rules[symbols[long] - self.first]
            symbols = np.repeat(symbols, 1 + long)
            symbols[at], symbols[at + 1] = pair[:, 0], pair[:, 1]
        return spread(flat, begin.take(symbols), size.take(symbols))

    def ids(self, i: int) -> np.ndarray:
        return self.expand(self.symbols(int(self.ends[i - 1]) if i else 0, int(self.ends[i])))

    def all(self) -> Iterator[tuple[int | None, np.ndarray]]:
        ids, ends = self.expand(self.symbols(0, self.n_symbols)), np.cumsum(self.counts)
        for doc_id, n, end in zip(self.doc_ids, self.counts.tolist(), ends.tolist()):
            yield doc_id, ids[end - n : end]


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, shard_ids: int = SHARD_IDS) -> None:
    """Encode documents (doc_id, text) in ascending doc_id order to shards under path.

    Nulls: a null text is empty (its one id is end_id); null doc_ids come first. Repeated rows
    are kept. No rows make no shard. Rows are dealt to tasks by ranges of doc_id.
    """
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, task, seq = shared_tokenizer(vocabulary), TaskContext.get().partitionId(), 0
        first = max(tokenizer.n_ids, end_id + 1)
        ids: list = []
        raws: list[bytes] = []
        size = total = 0

        def shard() -> pa.RecordBatch:
            nonlocal seq, size, total
            counts = np.array([len(r) // 4 for r in raws], np.int64)
            blob = encode_shard(ids, counts, np.frombuffer(b"".join(raws), "<u4"), total, first)
            out = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((task, pa.int32()), (seq, pa.int32()), (int(counts.sum()), pa.int64()), (blob, pa.binary()))], ["task", "seq", "n_ids", "blob"])
            seq, total = seq + 1, total + int(counts.sum())
            ids.clear()
            raws.clear()
            size = 0
            return out

        for b in gathered(batches, 4096, 16 << 20):
            for doc_id, raw in zip(b.column(0).to_pylist(), tokenizer.ids(b.column(1))):
                ids.append(doc_id)
                raws.append(raw + end)
                size += len(raw) // 4 + 1
                if size >= shard_ids:
                    yield shard()
        if ids:
            yield shard()

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id").asc_nulls_first())
    with batched(spark):
        dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first()).mapInArrow(lean(run, blocks=False), "task int, seq int, n_ids long, blob binary").write.parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """Per document from the shards: doc_id, start, n_tokens, ids_crc32 (of its decoded ids).

    The ids before a task's first shard are known from one sum a task, of which there are as many
    as partitions; a shard's own header holds the ids before it within its task.
    """
    shards = spark.read.schema("task int, seq int, n_ids long, blob binary").parquet(path)
    before, total = {}, 0
    for task, n in sorted(tuple(r) for r in shards.groupBy("task").agg(F.sum("n_ids")).collect()):
        before[task] = total
        total += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for task, blob in zip(b.column(0).to_pylist(), b.column(1)):
                shard = Shard(blob.as_buffer())
                rows, start = [], before[task] + shard.start
                for doc_id, ids in shard.all():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False))))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("task", "blob").mapInArrow(lean(run, blocks=False), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the documents' shards to the shared folder and read them back."""
    path = shared_dir(docs.sparkSession, "token-shards")
    write_shards(docs, path, vocabulary)
    return read_shards(docs.sparkSession, path)

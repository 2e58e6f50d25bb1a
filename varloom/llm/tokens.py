"""Token ids of whole texts by a public vocabulary, with a bounded cache of words.

The vocabulary drops white space and never merges over it, so a text's ids are those of its
white-space separated words. Words repeat; a worker keeps the packed ids of those it has met, for
its later tasks too.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces of words kept by a worker: those met lately, in two generations of half of these each.
MOST_WORDS = 600_000
#: Words whose ids are put together at a time.
SLICE_WORDS = 1 << 18
#: The letter that stands for each byte in the vocabulary: printable Latin-1 for itself, the others from U+0100 on.
PRINTABLE = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
BYTE_LETTERS = [chr(b) if b in PRINTABLE else "" for b in range(256)]
for i, b in enumerate(b for b in range(256) if b not in PRINTABLE):
    BYTE_LETTERS[b] = chr(256 + i)
TAILS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The letters up to U+00FF.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def gathered(batches: Iterator[pa.RecordBatch], most_rows: int = 2048, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches joined up to a number of rows or bytes: the more words meet, the fewer are looked up."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= most_rows or sum(x.nbytes for x in held) >= most_bytes:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def spread(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of values that begin at `begin` and have `size` members, one after the other."""
    end = np.cumsum(size)
    at = np.arange(end[-1] if len(end) else 0)
    at += np.repeat(begin - (end - size), size)
    return values.take(at)


def listed(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


class WordTokenizer:
    """ids(texts): for each text its ids as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str | None = None, most_words: int | None = None):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.tokenize = self.tokenizer.model.tokenize
        self.most_words = most_words or MOST_WORDS
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: All ids lie below this.
        self.n_ids = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def _plain(self, word: str) -> bytes:
        """Lower-case letters up to U+00FF are one piece and are normalised already: the model alone does."""
        if not word.isascii():
            word = "".join(map(BYTE_LETTERS.__getitem__, word.encode()))
        return array("I", [x.id for x in self.tokenize(word)]).tobytes()

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _known(self, words: list[str], plain: bool) -> list[bytes]:
        young, old = self.young, self.old
        got = list(map(young.get, words))
        missed = [i for i, x in enumerate(got) if x is None]
        if missed:
            for i in missed:
                got[i] = old.get(words[i])
            new = [i for i in missed if got[i] is None]
            for i, ids in zip(new, map(self._plain, [words[i] for i in new]) if plain else self._whole([words[i] for i in new])):
                got[i] = ids
            young.update((words[i], got[i]) for i in missed if len(words[i]) < 100)
            if len(young) > self.most_words // 2:
                self.young, self.old = {}, young
        return got

    def ids(self, texts: pa.Array | list) -> list[bytes]:
        """Words are split and told apart by Arrow; each different piece of a batch is looked up once.

        A word of LETTERS with TAILS behind (no apostrophe among them) is two pieces, of which the
        first is lowered; the piece of any other word is the word itself.
        """
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        if not len(coded):
            return [b""] * len(texts)
        words = coded.dictionary
        core = pc.utf8_rtrim(words, characters=TAILS)
        simple = pc.match_substring_regex(core, f"^[{LETTERS}]+$")
        low = pc.utf8_lower(core.filter(simple)).dictionary_encode()
        tail = pc.utf8_ltrim(words.filter(simple), characters=LETTERS).dictionary_encode()
        other = words.filter(pc.invert(simple))
        got = self._known(listed(low.dictionary), True)
        n_low = len(got)
        got += self._known(listed(tail.dictionary), False)
        n_tail = len(got)
        got += self._known(listed(other), False)
        got.append(b"")
        # two pieces a word: of a simple one its letters and what follows them, of another itself and nothing
        is_simple = simple.to_numpy(zero_copy_only=False)
        pieces = np.full((len(words), 2), len(got) - 1, np.int64)
        pieces[is_simple, 0] = low.indices.to_numpy()
        pieces[is_simple, 1] = tail.indices.to_numpy() + n_low
        pieces[~is_simple, 0] = np.arange(n_tail, len(got) - 1)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        begins, pairs = np.cumsum(sizes) - sizes, pieces.ravel()
        of_words = spread(np.frombuffer(b"".join(got), np.uint32), begins.take(pairs), sizes.take(pairs))
        sizes = sizes.take(pieces).sum(1)
        begins, which = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        upto = np.append(0, np.cumsum(sizes.take(which)))
        out = np.empty(upto[-1], np.uint32)
        for i in range(0, len(which), SLICE_WORDS):
            some = which[i : i + SLICE_WORDS]
            out[upto[i] : upto[i + len(some)]] = spread(of_words, begins.take(some), sizes.take(some))
        raw = memoryview(out).cast("B")
        at = (upto[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4).tolist()
        return [bytes(raw[x:y]) for x, y in zip(at, at[1:])]


@functools.lru_cache(maxsize=1)
def shared_tokenizer(path: str | None = None, most_words: int | None = None) -> WordTokenizer:
    """This process's tokenizer; its words serve later tasks."""
    return WordTokenizer(path, most_words)

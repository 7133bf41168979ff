"""Token ids of whole columns by a word-level BPE file: each distinct word is encoded once.

The file's tokenizer normalizes a text and splits it into words; a word's ids depend on the word
alone. So the library's tokenizer is asked only about words that this worker hasn't met; a text
whose normal form isn't plain lower case goes to it as a whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from tidemark.llm.words import blocks, gather, split_words


class WordEncoder:
    """A tokenizer and the ids of the words met so far, at most ``known_words`` of them; the first
    ones met are kept, and others are encoded anew each time."""

    _own: dict[str, WordEncoder] = {}

    @classmethod
    def shared(cls, path: str) -> WordEncoder:
        """One per worker process and file; workers serve many tasks."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def __init__(self, path: str, known_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known_words = known_words
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        # Tokens that end a word.
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # Hashes in order, and for each the run of its ids in the pool.
        self.hashes = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for at in range(0, len(texts), 10_000):
            batch = self.tokenizer.encode_batch_fast(texts[at:at + 10_000], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in batch]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and how many each has. Words go to the tokenizer
        many at a time, with spaces between: it splits them there again."""
        lines = [" ".join(words[at:at + 1000]) for at in range(0, len(words), 1000)]
        ids, sizes = [], []
        for i, e in enumerate(self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            ids.append(np.array(e.ids, np.uint32))
            counts = np.diff(np.flatnonzero(self.closing[ids[-1]]), prepend=-1)
            if len(counts) != len(words[1000 * i:1000 * i + 1000]):
                # Words that the tokenizer splits further: one by one.
                own = self.encode(words[1000 * i:1000 * i + 1000])
                ids[-1] = np.concatenate(own)
                counts = np.fromiter(map(len, own), np.int64, len(own))
            sizes.append(counts)
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(sizes)

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        values = [t or "" for t in texts.to_pylist()]
        out: list[np.ndarray] = []
        for a, b in blocks(values):
            out += self._block(values[a:b])
        return out

    def _block(self, values: list[str]) -> list[np.ndarray]:
        lowered, odd = [], []
        for i, text in enumerate(values):
            low = text.lower()
            # A capital sigma's lower case depends on its place; a few letters become two.
            if not text.isascii() and (not unicodedata.is_normalized("NFC", text)
                                       or "Σ" in text or len(low) != len(text)):
                odd.append(i)
                low = ""
            lowered.append(low)
        words = split_words(lowered, spaced=False)
        coded = pa.array(words.hashes).dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        example = np.zeros(len(distinct), np.int64)
        example[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        begins, lengths, pool = self._ids_of(words, distinct, example)
        begins, lengths = begins[codes], lengths[codes]
        long = np.flatnonzero(words.hashes == 0)
        if len(long):
            own, sizes = self.encode_words([words.word(w) for w in long])
            begins[long] = len(pool) + sizes.cumsum() - sizes
            lengths[long] = sizes
            pool = np.concatenate([pool, own])
        ids, ends = gather(pool, begins, lengths)
        cuts = ends[words.cuts]
        out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for i in odd:
            out[i] = self.encode([values[i]])[0]
        return out

    def _ids_of(self, words, distinct: np.ndarray, example: np.ndarray):
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        begins = np.where(known, self.begins[at] if len(self.hashes) else 0, 0)
        lengths = np.where(known, self.lengths[at] if len(self.hashes) else 0, 0)
        missing = np.flatnonzero(~known & (distinct != 0))
        if not len(missing):
            return begins, lengths, self.pool
        own, sizes = self.encode_words([words.word(w) for w in example[missing]])
        begins[missing] = len(self.pool) + sizes.cumsum() - sizes
        lengths[missing] = sizes
        pool = np.concatenate([self.pool, own])
        keep = missing[:max(0, self.known_words - len(self.hashes))]
        if len(keep):
            self.pool = pool[:int(begins[keep[-1]] + lengths[keep[-1]])]
            hashes = np.concatenate([self.hashes, distinct[keep]])
            order = np.argsort(hashes)
            self.hashes = hashes[order]
            self.begins = np.concatenate([self.begins, begins[keep]])[order]
            self.lengths = np.concatenate([self.lengths, lengths[keep]])[order]
        return begins, lengths, pool

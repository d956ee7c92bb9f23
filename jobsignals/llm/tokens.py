"""Token ids of whole texts, with each distinct word encoded once per worker."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from jobsignals.llm.common import batches, strings, word_lists

#: The id that ends every document.
END_ID = 1
#: Words kept by a worker; the memory of a worker stays bounded, the ids are the same.
MOST_WORDS = 400_000
#: Bytes of kept words and their ids, for words of any length.
MOST_BYTES = 64 << 20
#: New words handed to the tokenizer at once, whose encodings are large.
ENCODE_WORDS = 8192
#: Plain words joined to one text for the tokenizer, which spends more on a text than on a word.
JOINED_WORDS = 128
#: Bytes of text encoded at once.
BATCH_BYTES = 2 << 20
#: Latin letters, then punctuation that no rule of the tokenizer joins with letters.
SIMPLE = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class KnownWords:
    """Distinct words and the bytes of their ids, looked up by whole batches in Arrow arrays."""

    def __init__(self):
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.again = np.zeros(0, bool)  # words that a later batch had too

    def __len__(self) -> int:
        return len(self.words)

    def keep(self, kept: np.ndarray) -> None:
        at = pa.array(np.flatnonzero(kept))
        self.words, self.ids = self.words.take(at), self.ids.take(at)
        self.again = np.zeros(len(at), bool)

    def find(self, words: pa.Array, encode: Callable[[list[str]], pa.Array]) -> pa.Array:
        """Ids of distinct words; the unknown ones are encoded and kept."""
        found = pc.index_in(words, value_set=self.words)
        hole = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        self.again[at[~hole]] = True
        new = words.filter(pa.array(hole))
        if len(new):
            at[hole] = len(self) + np.arange(len(new))
            self.ids = pa.concat_arrays([self.ids, encode(strings(new))])
            self.words = pa.concat_arrays([self.words, new])
            self.again = np.append(self.again, np.zeros(len(new), bool))
        return self.ids.take(pa.array(at))


def id_values(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ids, given by their ends, as binary values."""
    offsets = 4 * np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


class WordTokens:
    """Ids by word, for tokenizers that drop white space and never join across it.

    Lower-cased cores and punctuation tails are encoded apart where both are plain, which the
    tokenizer does as well; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.light = Tokenizer(self.whole.model)
        self.light.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab()
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.last = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        if suffix:  # ids that can only be a word's last one
            self.last[[k for piece, k in vocabulary.items() if piece.endswith(suffix)]] = True
        self.most = most_words
        self.cores, self.others = KnownWords(), KnownWords()

    @property
    def places(self) -> list[str]:
        return strings(self.cores.words)

    @property
    def n_words(self) -> int:
        return len(self.cores) + len(self.others)

    @property
    def n_bytes(self) -> int:
        return sum(x.words.nbytes + x.ids.nbytes for x in (self.cores, self.others))

    def trim(self) -> None:
        """Forget the words seen in one batch only, or all if most were seen again."""
        for known in (self.cores, self.others):
            known.keep(known.again)
        if 2 * self.n_words > self.most or 2 * self.n_bytes > MOST_BYTES:
            self.cores, self.others = KnownWords(), KnownWords()

    def _apart(self, words: list[str], tokenizer) -> pa.Array:
        """Each word encoded as a text of its own."""
        ids = [e.ids for i in range(0, len(words), ENCODE_WORDS) for e in
               tokenizer.encode_batch_fast(words[i:i + ENCODE_WORDS], add_special_tokens=False)]
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        return id_values(np.fromiter(chain.from_iterable(ids), np.uint32), ends)

    def _joined(self, words: list[str]) -> pa.Array:
        """Many plain words encoded as one text, parted again after the ids that end a word."""
        texts = [" ".join(words[i:i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        step = ENCODE_WORDS // JOINED_WORDS
        ids = np.concatenate([
            np.array(e.ids, np.uint32) for i in range(0, len(texts), step) for e in
            self.light.encode_batch_fast(texts[i:i + step], add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # the vocabulary does not mark ends, or lacks some letter
            return self._apart(words, self.light)
        return id_values(ids, ends)

    def _whole(self, words: list[str]) -> pa.Array:
        return self._apart(words, self.whole)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of the texts."""
        if self.n_words > self.most or self.n_bytes > MOST_BYTES:
            self.trim()
        coded, offsets = word_lists(texts)
        if not len(coded):
            return np.zeros(0, np.uint32), offsets
        words = coded.dictionary
        parts = pc.extract_regex(words, SIMPLE)
        plain = parts.is_valid()
        parts = parts.filter(plain)
        core = pc.utf8_lower(pc.struct_field(parts, "core")).dictionary_encode()
        tail = pc.struct_field(parts, "tail").dictionary_encode()
        both = pc.binary_join_element_wise(
            self.cores.find(core.dictionary, self._joined).take(core.indices),
            self.others.find(tail.dictionary, self._whole).take(tail.indices),
            pa.scalar(b"", pa.large_binary()))
        rest = self.others.find(words.filter(pc.invert(plain)), self._whole)
        plain = plain.to_numpy(zero_copy_only=False)
        at = np.empty(len(words), np.int32)
        at[plain], at[~plain] = np.arange(len(both)), len(both) + np.arange(len(rest))
        taken = pa.concat_arrays([both, rest]).take(pa.array(at[np.asarray(coded.indices)]))
        _, ends, data = taken.buffers()
        ends = np.frombuffer(ends, np.int64, len(taken) + 1) // 4
        return np.frombuffer(data, np.uint32, int(ends[-1])), ends[offsets]


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """The coder of a Python worker, kept for its later tasks."""
    return WordTokens(path)


def token_batches(part: pa.Array, coder: WordTokens) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids with the end id) of every text of a batch."""
    for start, stop in batches(part, BATCH_BYTES):
        ids, offsets = coder.encode(part.slice(start, stop - start))
        for row in range(stop - start):
            yield start + row, np.append(ids[offsets[row]:offsets[row + 1]],
                                         np.uint32(END_ID))

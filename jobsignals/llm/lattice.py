"""A lattice over subword pieces: all segmentations of a word at once, for many words at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from jobsignals.llm.common import U64, mix

MARK = "▁"  # begins a word in the vocabulary
BASE = U64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a vocabulary, found by hash, and the bytes that stand for other characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes = np.full(256, -1, np.int64)
        usable, ids = [], []
        for i in range(self.size):
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                if MARK not in piece[1:]:
                    usable.append(piece)
                    ids.append(i)
        self.longest = max(map(len, usable))
        # The vocabulary ranks its pieces by score; 1 / rank is where the weights begin.
        scores = np.array([model.get_score(i) for i in range(self.size)])
        self.start = np.zeros(self.size)
        used = np.array(ids + [i for i in self.bytes.tolist() if i >= 0])
        order = used[np.argsort(-scores[used], kind="stable")]
        self.start[order] = 1 / np.arange(1, len(order) + 1)
        self.used = np.sort(used)
        key = np.array([self._hash(p) for p in usable], np.uint64)
        place = np.argsort(key)
        self.keys, self.ids = key[place], np.array(ids, np.int64)[place]
        assert len(np.unique(key)) == len(key)
        # A table by the upper bits; the few pieces that share a place are looked up apart.
        self.shift = U64(64 - 19)
        self.slots = np.full(1 << 19, -1, np.int64)
        at = (self.keys >> self.shift).astype(np.int64)
        self.slots[at[::-1]] = np.arange(len(at))[::-1]
        lost = self.slots[at] != np.arange(len(at))
        self.more_keys, self.more = self.keys[lost], np.flatnonzero(lost)

    def _hash(self, piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * BASE + U64(ord(c))
        return mix(h)[0]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of hashed strings, -1 for those that are no piece."""
        h = mix(h)
        at = self.slots[(h >> self.shift).astype(np.int64)]
        out = np.where((at >= 0) & (self.keys[at] == h), self.ids[at], -1)
        if len(self.more_keys):
            place = np.minimum(np.searchsorted(self.more_keys, h), len(self.more_keys) - 1)
            hit = self.more_keys[place] == h
            out[hit] = self.ids[self.more[place[hit]]]
        return out


class Lattice:
    """Edges (start, end, piece ids) of words of one length, and the sums over all paths."""

    def __init__(self, pieces: Pieces, words: list[str]):
        self.n, self.length = len(words), len(words[0]) + 1
        data = "".join(MARK + w for w in words).encode("utf-32-le")
        chars = np.frombuffer(data, np.uint32).reshape(self.n, self.length)
        self.edges: list[tuple[int, int, np.ndarray]] = []
        self.unknown: list[tuple[int, np.ndarray, np.ndarray]] = []
        codes = chars.astype(np.uint64)
        for i in range(self.length):
            h = np.zeros(self.n, np.uint64)
            for j in range(i, min(i + pieces.longest, self.length)):
                h = h * BASE + codes[:, j]
                ids = pieces.find(h)
                if (ids >= 0).any():
                    self.edges.append((i, j + 1, ids))
                if j == i and (ids < 0).any():
                    # Characters outside the vocabulary are spelt as bytes.
                    rows = np.flatnonzero(ids < 0)
                    spelt = np.full((len(rows), 4), -1, np.int64)
                    for k, r in enumerate(rows):
                        raw = chr(int(chars[r, i])).encode("utf-8", "surrogatepass")
                        spelt[k, :len(raw)] = pieces.bytes[list(raw)]
                    self.unknown.append((i, rows, spelt))

    def _steps(self, logs: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        padded = np.append(logs, -np.inf)  # id -1
        for i, j, ids in self.edges:
            yield i, j, padded[ids]
        for i, rows, spelt in self.unknown:
            value = np.full(self.n, -np.inf)
            value[rows] = np.append(logs, 0.0)[spelt].sum(axis=1)
            yield i, i + 1, value

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """Log of the sum over all paths to each place; the last column is the word's."""
        alpha = np.full((self.length + 1, self.n), -np.inf)
        alpha[0] = 0
        for i, j, value in sorted(self._steps(logs), key=lambda s: s[0]):
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + value)
        return alpha

    def expected(self, logs: np.ndarray, weight: np.ndarray, out: np.ndarray) -> float:
        """Adds each piece's expected count to out; gives the log-likelihood."""
        alpha = self.forward(logs)
        beta = np.full((self.length + 1, self.n), -np.inf)
        beta[self.length] = 0
        for i, j, value in sorted(self._steps(logs), key=lambda s: -s[1]):
            beta[i] = np.logaddexp(beta[i], beta[j] + value)
        whole = alpha[self.length]
        padded = np.append(logs, -np.inf)
        for i, j, ids in self.edges:
            share = np.exp(alpha[i] + padded[ids] + beta[j] - whole) * weight
            hit = ids >= 0
            out += np.bincount(ids[hit], share[hit], minlength=len(out))
        for i, rows, spelt in self.unknown:
            value = np.append(logs, 0.0)[spelt].sum(axis=1)
            share = np.exp(alpha[i][rows] + value + beta[i + 1][rows] - whole[rows]) * weight[rows]
            for column in spelt.T:
                hit = column >= 0
                out += np.bincount(column[hit], share[hit], minlength=len(out))
        return float((whole * weight).sum())


def by_length(words: list[str], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words of equal length, some characters at a time."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        for part in np.array_split(at, -(-len(at) * int(n + 1) // most)):
            if len(part):
                yield part, [words[k] for k in part]

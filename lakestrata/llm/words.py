"""Words of many texts at once, as arrays: spans, hashes and hashes of word windows."""

from __future__ import annotations

import numpy as np

# White space of the word definition [^\x20\x09-\x0D]+; bytes.split() uses the same set.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BLOCK = 1 << 16
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_GRAM = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


class Words:
    """The words of a slice of texts. Word i is ``buffer[starts[i]:ends[i]]`` and belongs to text ``owner[i]``;
    text d has the words ``first[d]`` to ``first[d + 1]``."""

    def __init__(self, texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        self.buffer = b"\n".join([*texts, b""])
        self.bytes = np.frombuffer(self.buffer, np.uint8)
        self.white = WHITE[self.bytes]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        edge = np.flatnonzero(self.white[1:] != self.white[:-1]) + 1
        if len(self.bytes) and not self.white[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        out = np.zeros(len(self.starts), np.uint64)
        for lo in range(0, len(out), _BLOCK):
            s, e = self.starts[lo : lo + _BLOCK], self.ends[lo : lo + _BLOCK]
            begin, end = int(s[0]), int(e[-1])
            lengths = e - s
            powers = np.cumprod(np.full(int(lengths.max()) + 1, _STEP, np.uint64))
            local = np.arange(begin, end) - np.repeat(s, np.diff(np.append(s, end)))
            local[local >= len(powers)] = 0
            values = _BYTE[self.bytes[begin:end]] * powers[local]
            values[self.white[begin:end]] = 0
            out[lo : lo + _BLOCK] = np.add.reduceat(values, s - begin) + lengths.astype(np.uint64)
        return mix(out)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of k words inside one text."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = window_hashes(hashes, k)
        inside = np.flatnonzero(self.owner[:n] == self.owner[k - 1 :])
        return inside, total[inside]


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbours, whatever text they belong to."""
    n = len(hashes) - k + 1
    total = np.full(n, np.uint64(k))
    for j in range(k):
        total += hashes[j : j + n] * _GRAM[j]
    return mix(total)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.concatenate([[False], s[1:] == s[:-1]])
    same[:-1] |= same[1:]
    out = np.empty(len(keys), bool)
    out[order] = same
    return out

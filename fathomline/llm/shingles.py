"""Word shingles of whole texts as 64-bit hashes, for many texts at once.

Words are runs without white space, compared as they stand. A text of at least one but fewer words than a shingle
has takes all its words as one shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORDS_PER_SHINGLE = 5
_REMEMBERED = 400_000
_U64 = np.uint64


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return value


_known = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and where each text's words start (one entry more than texts)."""
    if len(_known) > _REMEMBERED:
        _known.clear()
    parts, sizes = [], np.zeros(len(texts) + 1, dtype=np.int64)
    for i, t in enumerate(texts):
        words = t.encode("utf-8", "surrogatepass").split() if t else []
        sizes[i + 1] = len(words)
        parts.append(np.fromiter(map(_known.__getitem__, words), dtype=np.int64, count=len(words)))
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return flat.view(_U64), np.cumsum(sizes)


def shingle_hashes(texts: list[str | None], n: int = WORDS_PER_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, text after text, repeats included, and where each text's shingles start."""
    words, starts = word_hashes(texts)
    counts = np.diff(starts)
    total = np.zeros(len(words), dtype=_U64)
    seen = np.zeros(len(words), dtype=_U64)
    left = np.repeat(starts[1:], counts) - np.arange(len(words))  # words from here to the end of the text
    for k in range(n):
        here = left > k
        at = np.flatnonzero(here)
        total[at] = (total[at] + words[at + k]) * _U64(0x9E3779B97F4A7C15)
        total[at] ^= total[at] >> _U64(29)
        seen[at] += _U64(1)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.arange(len(words)) - np.repeat(starts[:-1], counts)
    kept = first < np.repeat(sizes, counts)
    return mixed(total[kept] + seen[kept]), np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(texts: list[str | None], n: int = WORDS_PER_SHINGLE) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    flat, starts = shingle_hashes(texts, n)
    return [np.unique(flat[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]

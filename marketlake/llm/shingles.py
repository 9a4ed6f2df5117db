"""Word shingles of many texts at once, as flat numpy arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from marketlake.llm.common import ship_by_value

ship_by_value(__name__)

#: Bytes of text that are hashed at a time.
BLOCK_BYTES = 2_000_000
#: Most texts of a block, however short.
BLOCK_TEXTS = 2_000

_U = np.uint64
# Fixed value: the white space of the contracts.
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: A random value for each byte, none for white space.
_BYTE = np.where(_IS_SPACE, _U(0), np.random.default_rng(20240115).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1))
_BASE = _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in one flat array, and each text's number of words."""
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    if not len(data):
        return np.empty(0, _U), np.zeros(len(texts), np.int64)
    space = _IS_SPACE[data]
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    counts = np.diff(np.searchsorted(starts, np.r_[begins, len(data)]))
    if not len(starts):
        return np.empty(0, _U), counts
    lengths = np.diff(np.r_[starts, len(data)])
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=_U))
    terms = _BYTE[data[starts[0]:]]
    terms *= powers[place]
    return mix64(np.add.reduceat(terms, starts - starts[0])), counts


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text in one flat array, and each
    text's number of them. Texts are lower-cased (A-Z); a text with fewer words
    than ``size`` has its whole sequence as its one shingle, one without words
    has none."""
    words, counts = word_hashes([t.lower() for t in texts])
    first = np.cumsum(counts) - counts
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(texts)), number)
    at = first[doc] + np.arange(len(doc)) - (np.cumsum(number) - number)[doc]
    width = np.minimum(counts, size)[doc]
    hashes = mix64(width.astype(_U))
    for k in range(size):
        inside = width > k
        hashes = np.where(inside, mix64(hashes * _BASE + words[np.where(inside, at + k, at)]), hashes)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])][: len(doc)]
    return hashes[new], np.bincount(doc[new], minlength=len(texts))


def text_blocks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as UTF-8 in blocks of about ``BLOCK_BYTES`` (or one longer text)
    and at most ``BLOCK_TEXTS`` texts."""
    block: list[bytes] = []
    held = begin = 0
    for i, text in enumerate(texts):
        block.append((text or "").encode("utf-8", "surrogatepass"))
        held += len(block[-1])
        if held >= BLOCK_BYTES or len(block) >= BLOCK_TEXTS or i + 1 == len(texts):
            yield begin, block
            block, held, begin = [], 0, i + 1

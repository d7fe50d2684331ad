"""Five-word shingles of texts as 64-bit hashes, many texts at a time in numpy.

A word is a run of anything but ASCII white space, with A-Z lowered.  Its hash
mixes its UTF-8 bytes, eight at a time, and a shingle's hash combines those of its words; two
different words or shingles have the same 64-bit hash with odds of about 2**-64, whatever
their letters (words of up to eight bytes never).  A text of fewer words than a shingle
has one shingle, the whole sequence; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Bytes of text that are hashed together; a longer text is hashed alone.
GROUP_BYTES = 1 << 18
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_COMBINE = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed random permutation of 64-bit values for each salt."""
    x = x ^ np.uint64((salt * 0x2545F4914F6CDD1D) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, extended when a longer group comes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.full(n, b, np.uint64) for b in (_BASE, _INVERSE))
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        if n <= GROUP_BYTES * 2 < len(self.up):  # do not keep what one very long text needed
            self.up, self.down = self.up[: GROUP_BYTES * 2].copy(), self.down[: GROUP_BYTES * 2].copy()
        return self.up[:n], self.down[:n]


powers = _Powers()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, for each text, the index of its first word (and the end).

    A word is cut into blocks of eight bytes; each block, with its place added, is mixed to 64
    bits, and the mixed blocks are summed and mixed again with the length.
    """
    raw = b"\n".join([b"", *texts, b""]).lower()
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    begins = np.cumsum([1] + [len(t) + 1 for t in texts])
    firsts = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), firsts
    at_byte = np.ndarray((len(raw),), "<u8", raw + bytes(8), strides=(1,))  # the eight bytes from each byte on
    length = ends - starts
    blocks = (length + 7) >> 3
    offsets = np.cumsum(blocks) - blocks
    place = np.arange(blocks.sum()) - np.repeat(offsets, blocks)
    value = at_byte[np.repeat(starts, blocks) + 8 * place]
    unused = np.clip(8 * (place + 1) - np.repeat(length, blocks), 0, 7).astype(np.uint64)  # bytes behind the word
    value &= np.uint64(2**64 - 1) >> (unused << np.uint64(3))
    value = mix(value + (place.astype(np.uint64) + np.uint64(1)) * _PLACE, 3)
    return mix(np.add.reduceat(value, offsets) + length.astype(np.uint64)), firsts


def _sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    hashes, firsts = word_hashes(texts)
    runs = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for j in range(words):
        runs += hashes[j : j + len(runs)] * _COMBINE[j % len(_COMBINE)] * np.uint64(2 * (j // len(_COMBINE)) + 1)
    runs = mix(runs, 1)
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= words:
            yield np.unique(runs[a : b - words + 1])
        elif b > a:
            own = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                own = mix(own * _COMBINE[0] + h, 2)
            yield own
        else:
            yield np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (null: none)."""
    group, size = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if group and size + len(data) > GROUP_BYTES:
            yield from _sets(group, words)
            group, size = [], 0
        group.append(data)
        size += len(data) + 1
    if group:
        yield from _sets(group, words)

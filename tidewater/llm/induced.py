"""Suffix sorting with common-prefix values by external induced sorting.

The text is a numpy string of small integers that ends in a unique 0.  The
order of its LMS suffixes is found by recursion: their substrings are sorted by
one induction, named, and the string of names is sorted the same way (names
that are all different, or too many for buckets, end the recursion).  From the
sorted LMS suffixes a second induction yields all others: L suffixes scanning
upwards, S suffixes scanning downwards.

Both scans work on priority queues keyed by first character, in which
suffixes with the same first character leave in the order they came; each is a
spool of blocks that moves to an unnamed temporary file beyond ``memory`` bytes.
The tuples in them are (position, common prefix with the tuple before).  When
a scan inserts the suffix before a scanned one, its common prefix with the
suffix inserted into that queue before is one more than the least common prefix
scanned in between.  So memory is the text and one block at a time, whatever
the queues hold.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16
MEMORY = 32 << 20
#: More names than this are sorted in memory instead of by buckets.
MAX_BUCKETS = 1 << 9
LIMIT = 1 << 29


class Queues:
    """First-in first-out queues of (position, common prefix), one per character."""

    def __init__(self, memory: int, kind: type):
        self.memory, self.held, self.kind = memory, 0, kind
        self.blocks: dict[int, list] = {}
        self.file = None

    def put(self, char: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        block = np.array([positions, prefixes], self.kind)
        self.blocks.setdefault(char, []).append(block)
        self.held += block.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for blocks in self.blocks.values():
            for i, block in enumerate(blocks):
                if isinstance(block, np.ndarray):
                    blocks[i] = (self.file.tell(), block.shape[1])
                    block.tofile(self.file)
        self.held = 0

    def load(self, block) -> np.ndarray:
        if isinstance(block, np.ndarray):
            return block
        at, n = block
        self.file.seek(at)
        return np.fromfile(self.file, self.kind, 2 * n).reshape(2, n)

    def _joined(self, blocks: list, down: bool = False) -> Iterator[np.ndarray]:
        """Blocks in order, small ones joined up to about ``BLOCK`` tuples."""
        some, size = [], 0
        for block in reversed(blocks) if down else blocks:
            own = self.load(block)
            if some and size + own.shape[1] > BLOCK:
                yield np.concatenate(some[::-1] if down else some, axis=1)
                some, size = [], 0
            some.append(own)
            size += own.shape[1]
        if some:
            yield np.concatenate(some[::-1] if down else some, axis=1)

    def take(self, char: int) -> Iterator[np.ndarray]:
        """The tuples of a queue so far, which leave it."""
        blocks = self.blocks.pop(char, [])
        self.held -= sum(b.nbytes for b in blocks if isinstance(b, np.ndarray))
        yield from self._joined(blocks)

    def each(self, char: int, down: bool = False) -> Iterator[np.ndarray]:
        """The tuples of a queue, which keeps them; ``down``: last block first."""
        yield from self._joined(self.blocks.get(char, []), down)


def places(text: np.ndarray) -> type:
    """The integers that hold a position of the text."""
    return np.int32 if len(text) < 1 << 30 else np.int64


def types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes: smaller than the suffix after them."""
    n = len(text)
    smaller = np.ones(n, bool)
    np.less(text[:-1], text[1:], out=smaller[:-1])
    differ = np.ones(n, bool)
    np.not_equal(text[:-1], text[1:], out=differ[:-1])
    place = np.where(differ, np.arange(n, dtype=places(text)), n)
    return smaller[np.minimum.accumulate(place[::-1])[::-1]]


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix lengths of the suffixes at ``a`` and ``b``, up to ``limit``."""
    n, found = len(text), np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    step = 16
    reach = np.arange(step)
    while len(live):
        x, y = a[live] + found[live], b[live] + found[live]
        left = np.minimum(x[:, None] + reach, n - 1)
        right = np.minimum(y[:, None] + reach, n - 1)
        same = (text[left] == text[right]) & (x[:, None] + reach < n) & (y[:, None] + reach < n)
        run = np.where(same.all(1), step, same.argmin(1))
        found[live] += run
        live = live[(run == step) & (found[live] < limit)]
    return np.minimum(found, limit)


class _Scan:
    """Inserts the predecessors of scanned suffixes; keeps the least common prefix
    scanned since the last insertion into each queue."""

    def __init__(self, text, is_s, queues, chars: int, want_s: bool):
        self.text, self.is_s, self.queues, self.want_s = text, is_s, queues, want_s
        self.least = np.full(chars, LIMIT, np.int64)
        self.fresh = np.ones(chars, bool)

    def scan(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        before = positions - 1
        ok = (before >= 0) & (self.is_s[before] == self.want_s)
        at = np.flatnonzero(ok)
        if len(at):
            chars = self.text[before[at]]
            # 16-bit keys are sorted by counting.
            order = np.argsort(chars.astype(np.uint16) if len(self.least) < 1 << 16 else chars, kind="stable")
            at, chars = at[order], chars[order]
            starts = np.flatnonzero(np.concatenate(([True], chars[1:] != chars[:-1])))
            ends = np.append(starts[1:], len(at))
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                c, own = int(chars[s]), at[s:e]
                # Least common prefix over (previous inserted, own]: the ranges tile the block.
                cuts = np.concatenate(([0], own[:-1] + 1))
                low = np.minimum.reduceat(prefixes[: own[-1] + 1], cuts)
                low[0] = min(low[0], self.least[c])
                made = low + 1
                if self.fresh[c]:
                    made[0], self.fresh[c] = 0, False
                self.queues.put(c, before[own], made)
                rest = prefixes[own[-1] + 1 :]
                self.least[c] = rest.min() if len(rest) else LIMIT
            touched = np.zeros(len(self.least), bool)
            touched[chars[starts]] = True
            others = ~touched
        else:
            others = slice(None)
        self.least[others] = np.minimum(self.least[others], prefixes.min())


def _pieces(positions: np.ndarray, prefixes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(0, len(positions), BLOCK):
        yield positions[i : i + BLOCK], prefixes[i : i + BLOCK]


def induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, prefixes: np.ndarray, limit: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (positions, common prefix with the suffix after), from the last suffix
    to the first, given the LMS suffixes in order."""
    chars = int(text.max()) + 1
    seed_chars = text[lms]
    bounds = np.searchsorted(seed_chars, np.arange(chars + 1))

    def seam(a, b) -> int:
        return int(common_prefix(text, np.array([a]), np.array([b]), limit)[0])

    # Upwards: L suffixes, induced from smaller L suffixes and LMS suffixes.
    kind = places(text)
    waiting, large = Queues(memory, kind), Queues(memory, kind)
    up = _Scan(text, is_s, waiting, chars, False)
    for c in range(chars):
        last = None
        while c in waiting.blocks:
            for own in waiting.take(c):
                large.put(c, own[0], own[1])
                up.scan(own[0], own[1])
                last = own[0][-1]
        seeds, own = lms[bounds[c] : bounds[c + 1]], prefixes[bounds[c] : bounds[c + 1]].copy()
        if len(seeds):
            own[0] = 0 if last is None else seam(last, seeds[0])
            for p, q in _pieces(seeds, own):
                up.scan(p, q)

    # Downwards: S suffixes, induced from larger S and L suffixes.
    waiting = Queues(memory, kind)
    down = _Scan(text, is_s, waiting, chars, True)
    for c in range(chars - 1, -1, -1):
        last = None
        while c in waiting.blocks:
            for own in waiting.take(c):
                yield own[0], own[1]
                down.scan(own[0], own[1])
                last = own[0][-1]
        carried = None if last is None else seam(last, large.load(large.blocks[c][-1])[0][-1]) if c in large.blocks else None
        for block in large.each(c, down=True):
            positions = block[0][::-1]
            # Upwards a tuple has the prefix shared with the one below; downwards with the one above.
            after = np.empty(len(positions), kind)
            after[0] = carried or 0
            after[1:] = block[1][::-1][:-1]
            carried = int(block[1][0])
            yield positions, after
            down.scan(positions, after)
        if c == 0:
            end = np.array([len(text) - 1])
            yield end, np.zeros(1, np.int64)


def _doubling(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names in memory, by prefix doubling."""
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    n, width = len(rank), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64))))
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


def _substring_names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings (in text order), given their order: equal ones equal."""
    lengths = np.append(np.diff(lms) + 1, 1)
    index = np.searchsorted(lms, order)
    a, b = index[:-1], index[1:]
    same = lengths[a] == lengths[b]
    live, at = np.flatnonzero(same), 0
    while len(live):
        live = live[lengths[a[live]] > at]
        differ = text[lms[a[live]] + at] != text[lms[b[live]] + at]
        same[live[differ]] = False
        live, at = live[~differ], at + 1
    names = np.empty(len(lms), np.int64)
    names[index] = np.cumsum(np.concatenate(([0], (~same).astype(np.int64))))
    return names


def sorted_lms(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, memory: int, max_buckets: int) -> np.ndarray:
    """The LMS positions in the order of their suffixes."""
    if len(lms) <= 1:
        return lms
    rough = lms[np.argsort(text[lms], kind="stable")]
    wanted = np.zeros(len(text), bool)
    wanted[lms] = True
    parts = [p[wanted[p]] for p, _ in induce(text, is_s, rough, np.zeros(len(rough), places(text)), 1, memory)]
    order = np.concatenate(parts)[::-1]
    names = _substring_names(text, lms, order)
    top = int(names.max()) + 1
    if top == len(lms):
        return order
    if top > max_buckets:
        return lms[_doubling(names)]
    # The last LMS suffix is the final 0, so its name is the smallest and unique.
    inner = np.concatenate([p for p, _ in suffixes(names, 1, memory, max_buckets)])[::-1]
    return lms[inner]


def suffixes(text: np.ndarray, limit: int = LIMIT, memory: int = MEMORY, max_buckets: int = MAX_BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (positions, common prefix with the suffix after), last suffix first.

    Common prefixes of LMS suffixes are measured up to ``limit``; induced values
    may be larger, and are right up to there.
    """
    if len(text) == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int64)
        return
    is_s = types(text)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(places(text))
    order = sorted_lms(text, is_s, lms, memory, max_buckets)
    prefixes = np.zeros(len(order), places(text))
    for i in range(1, len(order) if limit > 1 else 0, BLOCK):
        prefixes[i : i + BLOCK] = common_prefix(text, order[i - 1 : i + BLOCK - 1][: len(order) - i], order[i : i + BLOCK], limit)
    yield from induce(text, is_s, order, prefixes, limit, memory)

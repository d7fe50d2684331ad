"""BPE as a streaming transducer with bounded lookahead, and its decoder.

``lookahead`` computes from the merge list how many symbols to the right can
still change a token.  Compare the merges on a whole word with those on a
prefix of it, rule by rule.  Both agree left of some common boundary, at first
the prefix's end.  A rule (u, v) moves that boundary only by joining the u
before it with a v after it that exists in one of the two, so it moves left by
len(u); afterwards the tokens that begin there begin with u, so the next rule
(u2, v2) that moves it has a later rank and u as a prefix of v2.  The longest
such chain, found by one pass over the rules, bounds the total move.  Tokens
that end at least that far before the end of what has been read are therefore
final, and are emitted; the rest stays in the buffer.  The buffer holds
``lookahead + CHUNK`` symbols however long a word is.

Text is read piece by piece by the tokenizer's own rules (special tokens,
NFC, lower case, words); ids of short words are remembered in a table of
bounded size, kept per Python worker.

Defined results: null text is empty, its ids are empty and decode to "".
Repeated rows are encoded each.  Columns of the input come back unchanged,
with ``ids`` (little-endian unsigned 32-bit integers, binary) in place of or
added to them; ``decode`` adds ``decoded``.  Empty table: no rows.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

END = "</w>"
#: Symbols read beyond the lookahead before stable tokens are emitted.
CHUNK = 64
#: Characters of a text, up to the next space, whose words are listed together.
SLICE = 1 << 16
#: Words remembered by a worker: as many again from before the table was last full.
REMEMBERED = 100_000
#: After every rule.
NONE = (1 << 60, -1)
#: Bytes of results after which a batch is handed back.
BATCH_BYTES = 4 << 20
SPACE = "\t-\r \x85\xa0  -     　"


# What Unicode 16.0 adds to 15.1, for a Python that does not know it: letters,
# numbers; and lower-case forms of 16.0 and 17.0 (first, last, first of the others).
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)
LOWER_NEW = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B), (0x10D50, 0x10D65, 0x10D70),
             (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0x16EA0, 0x16EB8, 0x16EBB))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def lookahead(merges: list[tuple[str, str]], length=len) -> int:
    """Symbols after a boundary that suffice to make everything before it final."""
    reach: dict[str, int] = {}
    most = 0
    for u, v in merges:
        move = length(u) + max((reach.get(v[:i], 0) for i in range(1, len(v) + 1)), default=0)
        if move > reach.get(u, 0):
            reach[u] = move
        most = max(most, move)
    return most


@lru_cache(maxsize=4)
def _class(kind: str, top: int) -> str:
    """The characters of a general category as ranges of a regular expression.

    The library's classes are those of Unicode 16.0.  A Python that is older gets what that version
    added; of a newer one the classes are not known, so it is refused.
    """
    if tuple(map(int, unicodedata.unidata_version.split("."))) > (16, 99):
        raise RuntimeError(f"classes of Unicode 16.0 are needed, Python has {unicodedata.unidata_version}")
    added = {c for a, b in (LETTERS_16 if kind == "L" else NUMBERS_16) for c in range(a, b + 1)}
    ranges, start = [], None
    for c in range(top + 1):
        inside = c < top and (unicodedata.category(chr(c))[0] == kind or c in added)
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(ranges)


_NEW_CASE = {a + i: low + i for a, b, low in LOWER_NEW for i in range(b - a + 1)}
_FIRST_NEW = chr(min(_NEW_CASE))
_HAS_NEW_CASE = re.compile("[" + "".join(map(chr, _NEW_CASE)) + "]")


def lowered(text: str, top: str) -> str:
    """Lower case without the rule for a final sigma, also of letters that are newer than this
    Python; ``top`` is the text's largest character."""
    text = text.replace("Σ", "σ").lower()
    return text.translate(_NEW_CASE) if top >= _FIRST_NEW and _HAS_NEW_CASE.search(text) else text


@lru_cache(maxsize=2)
def _words(top: int) -> re.Pattern:
    letters, numbers = _class("L", top), _class("N", top)
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:[stmd]|re|ve|ll)|[^{SPACE}{letters}{numbers}]+")


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Names:
    """Token names by id and the special tokens: what decoding needs."""

    def __init__(self, spec: dict):
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: s for s, i in (spec["model"]["vocab"] | self.special).items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]


class Tokenizer(Names):
    """Merge rules, vocabulary and special tokens of one tokenizer file."""

    def __init__(self, path: str):
        spec = _spec(path)
        super().__init__(spec)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rules: dict[int, tuple[int, int]] = {}
        made = {s + e for s in byte_symbols() for e in ("", END)}
        for rank, (u, v) in enumerate(merges):
            if u not in made or v not in made:
                raise ValueError(f"rule {rank} uses a token that no earlier rule makes: {u} {v}")
            made.add(u + v)
            self.rules.setdefault(self.vocab[u] << 20 | self.vocab[v], (rank, self.vocab[u + v]))
        self.lookahead = lookahead(merges, lambda s: len(s.removesuffix(END)))
        self.inner = [self.vocab[s] for s in byte_symbols()]
        self.last = [self.vocab[s + END] for s in byte_symbols()]
        self.width = [len(n.removesuffix(END)) for n in self.names]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, ids: list[int]) -> list[int]:
        """``ids`` (used up) after all merges, lowest rank first, left to right."""
        find = self.rules.get
        found = [find(a << 20 | b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best is NONE:
                break
            at = found.index(best)
            ids[at] = best[1]
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = find(ids[at - 1] << 20 | ids[at], NONE)
            if at < len(found):
                found[at] = find(ids[at] << 20 | ids[at + 1], NONE)
        return ids

    def stream(self, symbols: Iterator[int]) -> Iterator[int]:
        """Tokens of one word from its byte symbols, each as soon as it is stable."""
        held: list[int] = []
        room = self.lookahead + CHUNK
        for s in symbols:
            held.append(s)
            if len(held) >= room + 1:
                # The newest symbol may be the word's last, which is written
                # differently; it waits outside the window.
                done = 0
                for token in self.merged(held[:-1]):
                    if done + self.width[token] > len(held) - 1 - self.lookahead:
                        break
                    done += self.width[token]
                    yield token
                held = held[done:]
        yield from self.merged(held)

    def word(self, word: str) -> bytes:
        """Ids of one word, as bytes."""
        packed = self.older.get(word)
        if packed is None:
            data = word.encode()
            symbols = [self.inner[b] for b in data]
            symbols[-1] = self.last[data[-1]]
            # A word that the buffer holds is emitted at its end.
            fits = len(symbols) <= self.lookahead + CHUNK
            packed = array("I", self.merged(symbols) if fits else self.stream(iter(symbols))).tobytes()
        if len(word) <= CHUNK:
            if len(self.known) >= REMEMBERED:
                self.older = dict(self.known)
                self.known.clear()
            self.known[word] = packed
        return packed

    def pieces(self, text: str) -> Iterator[bytes]:
        """Ids of the words and special tokens of a text, in order."""
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                yield array("I", [self.special[part]]).tobytes()
                continue
            if not unicodedata.is_normalized("NFC", part):
                part = unicodedata.normalize("NFC", part)
            top = max(part, default="")
            part = lowered(part, top)
            # Ranges beyond the basic plane make matching slow; few texts need them.
            words = _words(0x110000 if top > "￿" else 0x10000)
            known, make, begin = self.known.get, self.word, 0
            while begin < len(part):  # no word reaches across a space
                end = part.find(" ", begin + SLICE)
                end = len(part) if end < 0 else end
                yield b"".join([known(m) or make(m) for m in words.findall(part, begin, end)])
                begin = end

    def encode(self, text: str | None) -> bytes:
        return b"".join(self.pieces(text or ""))


class TextDecoder:
    """Incremental ids to text: tokens become bytes, bytes become characters when complete.

    ``spaced`` writes the tokens' names with a space between, as a tokenizer
    file without a decoder asks for; else names are mapped back to bytes and a
    word end becomes a space.
    """

    def __init__(self, tokenizer: Names, spaced: bool = True):
        back = {s: b for b, s in enumerate(byte_symbols())}
        special = set(tokenizer.special)
        if spaced:
            self.table = [n.encode() for n in tokenizer.names]
        else:
            self.table = [
                n.encode() if n in special else bytes(back[c] for c in n.removesuffix(END)) + b" " * n.endswith(END)
                for n in tokenizer.names
            ]
        self.gap = b" " if spaced else b""
        self.started = False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        if not ids:
            return ""
        data = self.gap.join(map(self.table.__getitem__, array("I", ids)))
        if self.started:
            data = self.gap + data
        self.started = True
        return self.state.decode(data)

    def flush(self) -> str:
        rest = self.state.decode(b"", True)
        self.state.reset()
        self.started = False
        return rest


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


@lru_cache(maxsize=4)
def _decoder(path: str, spaced: bool) -> TextDecoder:
    return TextDecoder(load(path) if load.cache_info().currsize else Names(_spec(path)), spaced)


def _mapped(df: DataFrame, column: str, into: dict, one) -> DataFrame:
    """``df`` with the columns ``into`` (name to type) = ``one(value of column)``, batch
    by batch, other columns untouched."""
    kept = [c for c in df.columns if c not in into]
    carried = df.select(F.struct(*kept).alias("row"), F.col(column).alias("given"))
    schema = StructType([carried.schema["row"], *[StructField(n, kind) for n, kind in into.items()]])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.binary() if isinstance(kind, BinaryType) else pa.string() for kind in into.values()]
        for batch in batches:
            given, start, held, made = batch.column("given"), 0, 0, []
            for i in range(len(given)):
                made.append(one(given[i].as_py()))
                held += sum(map(len, made[-1]))
                if held >= BATCH_BYTES or i == len(given) - 1:
                    rows = batch.column("row").slice(start, len(made))
                    columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([rows, *columns], names=["row", *into])
                    start, held, made = i + 1, 0, []

    mapped = carried.mapInArrow(run, schema)
    return mapped.select(*[F.col("row").getField(c).alias(c) for c in kept], *into)


def _decoded(value: bytes | None, path: str, spaced: bool) -> str:
    """The text of ids, read in pieces of 64k tokens."""
    machine = _decoder(path, spaced)
    step = 4 << 16
    parts = [machine.feed(value[i : i + step]) for i in range(0, len(value or b""), step)]
    return "".join(parts) + machine.flush()


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` (no special tokens added); ``path`` is the tokenizer file."""
    return _mapped(docs, text, {into: BinaryType()}, lambda value: (load(path).encode(value),))


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded", spaced: bool = True) -> DataFrame:
    """``encoded`` with the text of ``ids``."""
    return _mapped(encoded, ids, {into: StringType()}, lambda value: (_decoded(value, path, spaced),))


def encode_and_decode(
    docs: DataFrame, path: str, text: str = "text", into: tuple[str, str] = ("ids", "decoded"), spaced: bool = True
) -> DataFrame:
    """Both in one pass, so that a task needs one Python worker: ids, and the text decoded from them."""

    def one(value: str | None) -> tuple[bytes, str]:
        ids = load(path).encode(value)
        return ids, _decoded(ids, path, spaced)

    return _mapped(docs, text, {into[0]: BinaryType(), into[1]: StringType()}, one)

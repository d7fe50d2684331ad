"""Conversations formatted by a compiled template, with a loss mask, and read back.

The rows of a conversation are shuffled to one task by its id, sorted there by turn, and
streamed through the template's closures.  The output comes in parts of whole turns of
about ``PART_CHARS`` code points (one part for an ordinary conversation), so a
conversation with a third of all rows needs no more memory than its longest turn
and a part.  Each part holds its text and the spans that the template marks as
generated.

The default template has control strings of the kind ``<s>`` and ``[INST]``.  Its
``escape`` filter puts one more backslash behind the first character of everything in a
text that is a control string or one already escaped; ``unescape`` takes one away.  So
no text can open or close a turn, other texts stay as they are, and reading the
output back gives every text exactly.

Defined results
  null text or role: empty.  Any role name.  Null conv_id: the rows of one conversation
  without an id.  Rows of equal turn: by role, then text; null turns first; repeated rows
  are turns of their own.  Empty table: no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .templates import TURN, Template, joined

PART_CHARS = 1 << 20
_NAMES = r"/?(?:s|SYS|ROLE|END)>|/?INST\]"
CONTROL = re.compile(rf"([<\[])(\\*)({_NAMES})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_NAMES})")

#: A turn of any other role names it.  Every control string begins with ``<`` or ``[`` and
#: holds neither of them again, so text beside it cannot become part of one.
CHAT = """
{#- an assistant's turn is what stands between the others, up to the end mark -#}
{%- for m in messages -%}
  {%- if loop.first %}{{ '<s>' }}{% endif -%}
  {%- if m.role == 'user' %}{{ '[INST] ' }}{{ m.text | escape }}{{ ' [/INST]' }}
  {%- elif m.role == 'assistant' %}{{ ' ' }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ ' </s>' }}
  {%- elif m.role == 'system' %}{{ '<SYS> ' }}{{ m.text | escape }}{{ ' </SYS>' }}
  {%- else %}{{ '<ROLE>' }}{{ m.role | escape }}{{ '</ROLE> ' }}{{ m.text | escape }}{{ ' <END>' }}
  {%- endif -%}
{%- endfor -%}
"""

PARTS = "conv_id long, part long, formatted string, loss array<struct<begin:int,end:int>>"


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


@lru_cache(maxsize=16)
def compiled(source: str) -> Template:
    """The template, compiled once per process."""
    return Template(source, {"escape": lambda a: escape("" if a is None else str(a))})


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Each conversation's id and its messages, streamed from rows in order."""

    def rows():
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield from zip(*[part.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True)

    stream = rows()
    held = [next(stream, None)]

    def messages(key):
        while held[0] is not None and held[0][0] == key:
            _, role, text = held[0]
            held[0] = next(stream, None)
            yield {"role": role or "", "text": text or ""}

    while held[0] is not None:
        key = held[0][0]
        mine = messages(key)
        yield key, mine
        for _ in mine:  # a template need not read every message
            pass


def format_chats(rows: DataFrame, template: str = CHAT, part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, part, formatted, loss`` of ``rows(conv_id, turn, role, text)``.

    ``loss`` holds the spans of ``formatted`` in code points that the template marks as
    generated.  The parts of a conversation lie in order in one partition.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("part", pa.int64()),
                ("formatted", pa.string()),
                ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            ]
        )
        run = compiled(template)
        out, size = [], 0

        def flush():
            nonlocal out, size
            done = pa.RecordBatch.from_pylist(out, schema=schema)
            out, size = [], 0
            return done

        def close(key, part, pieces):
            nonlocal size
            text, spans = joined(pieces)
            out.append({"conv_id": key, "part": part, "formatted": text, "loss": [{"begin": b, "end": e} for b, e in spans]})
            size += len(text)

        for key, messages in _conversations(batches):
            pieces, chars, part = [], 0, 0
            for piece in run.pieces(messages=messages):
                if piece is not TURN:
                    pieces.append(piece)
                    chars += len(piece[0])
                elif chars >= part_chars:
                    close(key, part, pieces)
                    pieces, chars, part = [], 0, part + 1
                    yield flush()
            if pieces or not part:
                close(key, part, pieces)
            if size >= part_chars:
                yield flush()
        if out:
            yield flush()

    used = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    dealt = used.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(render, PARTS)


def in_order(parts: DataFrame) -> DataFrame:
    """Stored parts in the order that ``digests`` reads: each conversation in one partition, by part."""
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")


#: How a turn begins, how it ends, and its role (None: between the marks named).
_TURNS = (("[INST] ", " [/INST]", "user"), (" ", " </s>", "assistant"), ("<SYS> ", " </SYS>", "system"), ("<ROLE>", " <END>", None))


def turns(text: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the turns in a part that the default template made."""
    at = 3 if text.startswith("<s>") else 0
    while at < len(text):
        for opened, closed, role in _TURNS:
            if text.startswith(opened, at):
                break
        else:
            raise ValueError(f"no turn begins at {at}")
        begin = at + len(opened)
        if role is None:
            end = text.index("</ROLE> ", begin)
            role, begin = unescape(text[begin:end]), end + len("</ROLE> ")
        mark = closed.lstrip()
        end = text.index(mark, begin) - 1  # a text may end in what looks like the space before the mark
        yield role, unescape(text[begin:end])
        at = end + len(closed)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(parts: DataFrame) -> DataFrame:
    """What reading the output back gives, a row per conversation.

    The number of turns, the digest of ``role, \\n, text, \\n`` of every turn, code points
    and digest of the unescaped text under the loss mask, and the output's length.
    ``parts`` as ``format_chats`` returns them (stored ones: through ``in_order``); parts are
    read one after the other, so memory stays at one part.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        schema = pa.schema([(n, pa.string() if n.endswith("256") else pa.int64()) for n in names])
        done = []
        state = None

        def finish():
            key, n, turns_sha, chars, loss_sha, length = state
            done.append([key, n, turns_sha.hexdigest(), chars, loss_sha.hexdigest(), length])

        def flush():
            rows = [pa.array(c, t) for c, t in zip(zip(*done), schema.types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(rows, schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("conv_id", "formatted", "loss")}
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        finish()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, said in turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    learned = unescape(text[span["begin"] : span["end"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if len(done) >= 1000:
                yield flush()
        if state is not None:
            finish()
        if done:
            yield flush()

    return parts.select("conv_id", "formatted", "loss").mapInArrow(read, DIGESTS)

"""BPE against the public tokenizers library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Public

from tests.conftest import SF001
from tidewater.llm import bpe
from tidewater.llm.catalog import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def public():
    return Public.from_file(PATH)


def ids_of(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


CASES = [
    "",
    " \n\t ",
    "It's we'll they're I'M 'sno",
    "a" * 5000,
    "ab" * 4000 + "c",
    "naïve café Σίσυφος ΣΑΣ İstanbul ½ ² 123 x1y2",
    "<|startoftext|>hello<|endoftext|> world<|endoftext|",
    "\U0001f600 emoji \U00010400 deseret 𝔘nicode é Å",
    "tab\x1cfile\x85next\xa0nbsp em",
    "!!!??...###&&&%%%" * 50,
    "\x00\x01 control \x7f",
]


@pytest.mark.parametrize("text", CASES)
def test_encode_like_the_library(public, text):
    t = bpe.load(PATH)
    want = public.encode(text, add_special_tokens=False).ids
    got = t.encode(text)
    assert ids_of(got) == want
    machine = bpe.TextDecoder(t)
    parts = [machine.feed(got[i : i + 12]) for i in range(0, len(got), 12)]
    assert "".join(parts) + machine.flush() == public.decode(want, skip_special_tokens=False)


def test_every_code_point_like_the_library(public):
    """Classes, case and composition of all assigned planes, whatever this Python's Unicode version."""
    t = bpe.load(PATH)
    planes = [*range(0xD800), *range(0xE000, 0x33480), *range(0xE0000, 0xE0200), 0xF0000, 0x10FFFF]
    wrong = []
    for start in range(0, len(planes), 64):
        texts = [f"a{chr(c)}{chr(c)}1" for c in planes[start : start + 64]]
        joined = " ".join(texts)
        if ids_of(t.encode(joined)) != public.encode(joined, add_special_tokens=False).ids:
            wrong += [x for x in texts if ids_of(t.encode(x)) != public.encode(x, add_special_tokens=False).ids]
    assert wrong == []


def test_long_words_stream_with_bounded_buffer(public):
    t = bpe.load(PATH)
    assert 8 < t.lookahead < 2000
    rng = random.Random(5)
    for letters in ("ab", "etaoinshr", "abcdefghijklmnopqrstuvwxyz", "thing"):
        for _ in range(6):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(200, 3000)))
            assert ids_of(t.encode(word)) == public.encode(word, add_special_tokens=False).ids


def test_text_mode_round_trip():
    t = bpe.load(PATH)
    machine = bpe.TextDecoder(t, spaced=False)
    ids = t.encode("héllo wörld 日本語")
    out = "".join(machine.feed(ids[i : i + 4]) for i in range(0, len(ids), 4)) + machine.flush()
    assert out == "héllo wörld 日本語 "


def test_null_repeated_and_clashing_columns(spark):
    rows = [(1, None, "x"), (1, "the end", "y"), (1, "the end", "y"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    both = bpe.encode_and_decode(docs, PATH).collect()
    assert sorted(r.decoded for r in both) == ["", "", "the</w> end</w>", "the</w> end</w>"]
    assert [r.decoded for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()] == [r.decoded for r in both]
    out = bpe.encode(docs, PATH)
    assert sorted(out.columns) == ["doc_id", "ids", "text"] and out.count() == 4
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_query_whole_table(spark, public):
    import duckdb

    con = duckdb.connect()
    want = {}
    for doc_id, text in con.execute(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall():
        ids = public.encode(text or "", add_special_tokens=False).ids
        back = public.decode(ids, skip_special_tokens=False)
        want[doc_id] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op7_bpe"](spark, SF001).collect()}
    assert got == want

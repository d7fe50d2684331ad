"""The template language, chat formatting and reading back, with odd inputs."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import chat
from tidewater.llm.templates import Const, For, Output, Template, TemplateError, Text, fold, parse

SCHEMA = "conv_id long, turn long, role string, text string"


def out(source, **values):
    return Template(source).render(**values)[0]


def test_language():
    assert out("a{{ x }}b", x=3) == "a3b"
    assert out("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %}, {% endif %}{% endfor %}", xs="") == ""
    assert out("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %}, {% endif %}{% endfor %}", xs=["a", "b"]) == "1a, 2b"
    assert out("{% set y = x ~ '!' %}{{ y | upper | trim }}", x=" hi") == "HI!"
    assert out("{% if a == 1 %}one{% elif a > 2 and a != 4 %}more{% else %}other{% endif %}", a=3) == "more"
    assert out("{{ m['k'] }}{{ m.k }}{{ m.gone }}{{ none }}{{ true }}", m={"k": "v"}) == "vvtrue"
    assert out("{{ 'y' if x is defined else 'n' }}{{ 'y' if z is not defined }}{{ x | default('d') }}{{ q | default('d') }}", x=1) == "yy1d"
    assert out("a  {#- gone -#}  b {%- if true -%} c {%- endif %}") == "abc"
    assert out(r"{{ 'it\'s\n' }}{{ 7 % 4 + 1 - 2 }}{{ 'b' in 'abc' }}{{ 'b' not in x }}", x={"b": 1}) == "it's\n2truefalse"


def test_constants_fold():
    assert fold(parse("a{{ 'b' ~ 1 + 2 }}{% if 1 == 2 %}x{% elif true %}c{% else %}y{% endif %}{{ 'D' | lower }}")) == (Text("ab3cd"),)
    assert fold(parse("{{ x if 1 else y }}")) == fold(parse("{{ x }}"))
    tree = fold(parse("{% for m in messages %}{{ '<' }}{{ '[' }}{{ m }}{% endfor %}"))
    assert isinstance(tree[0], For) and tree[0].body[0] == Text("<[") and isinstance(tree[0].body[1], Output)
    assert fold(parse("{{ 'a' and 0 or 'z' }}")) == (Text("z"),) and parse("{{ 1 }}") == (Output(Const(1)),)


@pytest.mark.parametrize(
    "source",
    ["{{ x", "{{ }}", "{% if x %}", "{% endfor %}", "{{ x | nothing }}", "{{ x() }}", "{{ _x }}", "{{ x.__class__ }}", "{{ 2 * 2 }}",
     "{% for x in y %}{% endif %}", "{{ 'a }}", "{% import os %}", "{{ 1 % 0 }}", "{{ x %}", "{% set if = 1 %}"],
)
def test_outside_the_language(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_sandbox_reads_mappings_only():
    class Thing:
        secret = "s"

    assert out("{{ x.secret }}{{ x['secret'] }}{{ globals }}", x=Thing()) == ""


def test_generation_spans_and_lazy_items():
    t = Template("{% for m in ms %}<{% generation %}{{ m }}{{ '!' }}{% endgeneration %}>{% endfor %}")
    assert t.render(ms=iter(["ab", "c"])) == ("<ab!><c!>", [(1, 4), (6, 8)])
    seen = []

    def items():
        for i in range(10):
            seen.append(i)
            yield str(i)

    pieces = t.pieces(ms=items())
    next(pieces)
    assert len(seen) <= 2


CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<SYS>", "</SYS>", "<ROLE>", "</ROLE>", "<END>", "\\", "<", "[", "/", " ", "<\\/s>", "é", "\n", ">"]


@given(st.lists(st.sampled_from(CONTROLS)).map("".join))
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_leaves_no_control(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in CONTROLS[:9])


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</ROLE> "]), st.lists(st.sampled_from(CONTROLS)).map("".join)), min_size=1))
@settings(max_examples=300, deadline=None)
def test_conversations_read_back(said):
    text, spans = chat.compiled(chat.CHAT).render(messages=[{"role": r, "text": t} for r, t in said])
    assert list(chat.turns(text)) == said
    assert "".join(chat.unescape(text[b:e]) for b, e in spans) == "".join(t for r, t in said if r == "assistant")


def plain(rows):
    found, key = {}, lambda v: (v is not None, v if v is not None else 0)
    for conv, turn, role, text in sorted(rows, key=lambda r: (key(r[0]), key(r[1]), key(r[2]) if r[2] is not None else (False, ""), r[3] is not None, r[3] or "")):
        found.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, said in found.items():
        learned = "".join(t for r, t in said if r == "assistant")
        all_turns = "".join(f"{r}\n{t}\n" for r, t in said)
        out.append((conv, len(said), hashlib.sha256(all_turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(parts):
    return sorted((tuple(r)[:5] for r in chat.digests(parts).collect()), key=repr)


def rows():
    rng = random.Random(9)
    made = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), "".join(rng.choice(CONTROLS) for _ in range(rng.randint(0, 30))))
            for c in range(40) for t in range(rng.randint(1, 7))]
    made += [(3, 1, "user", "again")] * 2 + [(None, 0, "user", "no id"), (None, 1, "assistant", None), (50, None, None, None), (51, 0, "assistant", "")]
    made += [(60, t, "assistant" if t % 2 else "user", f"[INST] {t} " * 20) for t in range(400)]
    return made


def test_tables_read_back(spark):
    table = spark.createDataFrame(rows(), SCHEMA).withColumn("formatted", F.lit("x")).withColumn("part", F.lit(1))
    assert got(chat.format_chats(table)) == plain(rows())


def test_parts_bound_memory_and_read_back_from_storage(spark, tmp_path):
    parts = chat.format_chats(spark.createDataFrame(rows(), SCHEMA), part_chars=500)
    parts.repartition(5).write.parquet(str(tmp_path / "parts"))
    stored = spark.read.parquet(str(tmp_path / "parts"))
    assert stored.where("conv_id = 60").count() > 50
    assert stored.agg(F.max(F.char_length("formatted"))).first()[0] < 1200
    assert got(chat.in_order(stored)) == plain(rows())


def test_empty_table(spark):
    assert got(chat.format_chats(spark.createDataFrame([], SCHEMA))) == []

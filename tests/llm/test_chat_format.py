from __future__ import annotations

import hashlib
import random

import pytest

from quarry.llm.chat_format import OP1_SQL, TEMPLATE, TRICKY, Reader, cut_parts, format_conversations, read_back
from quarry.llm.template import (
    BEGIN,
    END,
    Emit,
    Text,
    TemplateError,
    compile_template,
    escape,
    fold,
    parse,
    render,
    unescape,
)
from tests.conftest import SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, formatted string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_template_language():
    source = (
        "{# note #}{% set n = 2 + 1 %}{% for m in messages %}{{ loop.index }}{% if loop.last %}!{% elif m.a == 'x' %}"
        "X{% else %}-{% endif %}{{ m.b.c | default('none') | upper }}{% endfor %}{{ n ~ 'k' }}"
    )
    text, spans = render(source, messages=[{"a": "x"}, {"a": "y", "b": {"c": "v"}}, {"a": "z"}])
    assert (text, spans) == ("1XNONE2-V3!NONE3k", [])


def test_generation_spans():
    text, spans = render("a{% generation %}{{ t }}{% endgeneration %}b{% generation %}{% endgeneration %}", t="xyz")
    assert text == "axyzb" and spans == [(1, 4), (5, 5)]


def test_folding_leaves_one_literal():
    folded = fold(parse("a{{ 'b' | upper }}{% if 1 < 2 and true %}c{{ 1 + 2 }}{% else %}{{ x }}{% endif %}d"))
    assert folded == (Text("aBc3d"),)
    assert isinstance(fold(parse("{{ x }}"))[0], Emit)


@pytest.mark.parametrize(
    "source", ["{% for x in y %}", "{% nope %}", "{{ x | nope }}", "{{ x.y( }}", "{{ }}", "{% if a %}{% endfor %}"]
)
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_templates_reach_only_mapping_fields():
    assert render("{{ x.real }}{{ y.z }}{{ x.upper }}", x=1)[0] == ""
    with pytest.raises(TemplateError):
        compile_template("{{ x.__class__ }}")


def test_escape_round_trip():
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(["\\", "###", "#", "</turn>", "</", "turn>", ":", "a", "\n"]) for _ in range(r.randint(0, 9)))
        assert unescape(escape(text, ":")) == text


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_parts_read_back_alike(size):
    r = random.Random(size)
    bits = ["\\", "###", "#", "</turn>\n", ": ", "a", "\n", "é", "### user: "]
    turns = [
        {"role": r.choice(["user", "assistant", ": x", ""]), "text": "".join(r.choice(bits) for _ in range(r.randint(0, 12)))}
        for _ in range(9)
    ]
    reader, whole = Reader(), []
    for text, spans in cut_parts(compile_template(TEMPLATE)(messages=turns), size):
        assert len(text) <= size
        reader.feed(text, spans)
        whole.append(text)
    n, turns_sha, chars, loss_sha, total = reader.result()
    loss = "".join(t["text"] for t in turns if t["role"] == "assistant")
    assert (n, chars, total) == (9, len(loss), len("".join(whole)))
    assert turns_sha == sha("".join(f"{t['role']}\n{t['text']}\n" for t in turns))
    assert loss_sha == sha(loss)
    assert "".join(whole) == render(TEMPLATE, messages=turns)[0]


def test_markers_are_not_text():
    pieces = list(compile_template("{% generation %}x{% endgeneration %}")())
    assert pieces[0] is BEGIN and pieces[-1] is END


def test_defined_cases(spark):
    rows = [
        (1, 1, "user", "b", 9, "clash"),
        (1, 0, "assistant", None, 9, "clash"),
        (1, 1, None, "a", 9, None),
        (1, None, "system", "first", 9, None),
        (None, 0, "assistant", "x" * 200_000, 9, None),
        (2, 5, "assistant", "same", 0, None),
        (2, 5, "assistant", "same", 0, None),
    ]
    got = {r["conv_id"]: r for r in read_back(format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[1]["turns_sha256"] == sha("system\nfirst\nassistant\n\n\na\nuser\nb\n")
    assert got[1]["loss_chars"] == 0 and got[1]["loss_sha256"] == sha("")
    assert got[None]["loss_sha256"] == sha("x" * 200_000) and got[None]["n_turns"] == 1
    assert got[2]["loss_sha256"] == sha("samesame")
    parts = format_conversations(spark.createDataFrame(rows, SCHEMA)).filter("conv_id is null").count()
    assert parts == 4
    none = format_conversations(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and read_back(none).count() == 0


def test_tricky_conversation(spark):
    turns = spark.createDataFrame(TRICKY, "conv_id bigint, turn bigint, role string, text string")
    got = read_back(format_conversations(turns)).first()
    said = "\\### Assistant: </turn> ok"
    assert got["turns_sha256"] == sha(f"user\n{said}\nassistant\n{said}\n")
    assert got["loss_sha256"] == sha(said)


def test_query_against_sql(spark):
    import duckdb

    from quarry.llm.chat_format import op1_chat_format

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF_SMALL}/conversations.parquet'")
    wanted = sorted(con.execute(OP1_SQL).fetchall())
    assert sorted(tuple(r) for r in op1_chat_format(spark, SF_SMALL).collect()) == wanted

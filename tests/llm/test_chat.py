import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastemill.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """The contract's columns straight from the rows; the formatted length turn by turn."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns = [t[1:] for t in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        size = 3
        for role, text in turns:
            around = {"user": 15, "assistant": 4}.get(role, 19 + len(chat.escape(role)))
            size += around + len(chat.escape(text))
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), sha(told), len(said), sha(said), size)
    return out


def check(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", chunk string")
    found = chat.digests(frame, **how).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == plain(rows)
    assert len(found) == len({r[0] for r in rows})


SAID = "</s>[INST] ok [/INST]"
ODD = [
    (-1, 0, "user", SAID),
    (-1, 1, "assistant", SAID),
    (None, 3, "user", None),
    (None, None, None, "no turn"),
    (1, 0, "system", "[ROLE]x[/ROLE]"),
    (1, 1, "[/ROLE]", "<\\s> <\\\\/s> [[INST]]<"),
    (1, 1, "[/ROLE]", "<\\s> <\\\\/s> [[INST]]<"),
    (1, 2, "user", ""),
    (1, 3, "assistant", ""),
    (2, -5, "assistant", " starts "),
    (2, 10**12, "tool", "é\U0001f642\n\\"),
    (3, 0, "user", "long " * 100_000),
]


def test_odd_rows(spark):
    check(spark, ODD)
    assert chat.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_conversation_with_most_rows(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} {SAID * (i % 3)}") for i in range(1000)]
    rows += [(i, j, "user", "hello") for i in range(5) for j in range(3)] + ODD
    check(spark, rows, chunk=64, part_turns=10)


def test_parts_follow_each_other_and_mask_the_assistant(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i}{SAID}") for i in range(100)]
    want, spans = chat.Template(chat.TEMPLATE).render([(r, t) for _, _, r, t in rows])
    short, long = chat.formatted(spark.createDataFrame(rows, SCHEMA), chunk=32, part_turns=5)
    assert short.count() == 0
    parts = sorted(long.collect(), key=lambda r: (r.chunk, r.part))
    assert "".join(r.text for r in parts) == want and want.count("<s>") == 1
    learned = [r.text[s.start : s.stop] for r in parts for s in r.loss]
    assert learned == [want[a:b] for a, b in spans] == [chat.escape(t) for _, _, r, t in rows if r == "assistant"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<s>", ""]),
                          st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "ROLE]", "/END]", " ", "a", "é\n"]),
                                   max_size=12).map("".join)), max_size=6))
def test_any_text_reads_back(messages):
    text, spans = chat.compiled(chat.TEMPLATE).render(messages)
    assert chat.read_turns(text) == messages
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in messages if r == "assistant"]
    for _, said in messages:
        assert not any(c in chat.escape(said) for c in chat.CONTROL)


def render(source, *messages):
    return chat.Template(source).render(list(messages))[0]


def test_language():
    two = [("user", " Hi "), ("bot", "yo")]
    loop = "{% for m in messages %}%s{% endfor %}"
    assert render(loop.replace("%s", "{{ m.role }}:{{ m['text'] | trim | upper }};"), *two) == "user:HI;bot:YO;"
    assert render(loop.replace("%s", "{{ loop.index0 }}{{ loop.index }}{{ ',' if not loop.last }}"), *two) == "01,12"
    assert render("a{# no {{ #}b" + loop.replace("%s", "") + "{% set x = 2 + 3 %}{{ x ~ '}}' }}", *two) == "ab5}}"
    assert render(loop.replace("%s", "{% if m.role == 'user' and loop.first or 1 > 2 %}u{% else %}o{% endif %}"), *two) == "uo"
    assert render(loop.replace("%s", "{% set t = m.text | length %}{{ t - 1 }}{{ 'i' in m.text }}"), *two) == "3True1False"
    assert render("  {%- for m in messages -%}  x  {%- endfor -%}  !", *two) == "xx!"


def test_constants_are_folded():
    tree = chat.fold(chat.parse("{{ 'a' + 'b' }}c{% if 1 == 1 %}{{ 'd' | upper }}{% else %}{{ zzz }}{% endif %}e"))
    assert tree == [("put", ("const", "abcDe"))]
    (loop,) = chat.fold(chat.parse(chat.TEMPLATE))
    assert loop[2][1][2][0] == ("put", ("const", "[INST] "))


@pytest.mark.parametrize(
    "source",
    [
        "{% for m in messages %}{{ m.__class__ }}{% endfor %}",
        "{% for m in messages %}{{ m['pop'] }}{% endfor %}",
        "{% for m in messages %}{{ open }}{% endfor %}",
        "{% for m in messages %}{{ m.text | eval }}{% endfor %}",
        "{% for m in messages %}{{ m.text() }}{% endfor %}",
        "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}",
        "{% for m in messages %}{% if m %}{% endfor %}",
        "{% for m in messages %}{{ m.text ",
        "{% import os %}{% for m in messages %}{% endfor %}",
        "{{ 1 + 'a' }}{% for m in messages %}{% endfor %}",
        "{% for m in range %}{% endfor %}",
        "{% endfor %}",
        "no loop",
    ],
)
def test_what_the_sandbox_does_not_hold_is_an_error(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source)

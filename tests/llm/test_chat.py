"""The template language, and conversations rendered and read back."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bookledger.llm.chat import escape, format_conversations, read_back, unescape
from bookledger.llm.template import Block, Const, Output, TemplateError, compile_template, fold, parse

from . import brute


def render(source, filters=None, **names):
    return "".join(text for text, _ in compile_template(source, filters or {})(names))


@pytest.mark.parametrize(
    ("source", "names", "expected"),
    [
        ("a{{ x }}b{# no #}", {"x": 1}, "a1b"),
        ("{{ x.y['z'] }}|{{ x.none }}|{{ missing.a }}", {"x": {"y": {"z": "deep"}}}, "deep||"),
        ("{{ 'a' ~ 1 ~ none }}{{ 1 + 2 }}", {}, "a13"),
        ("{% if a and not b %}1{% elif b or c %}2{% else %}3{% endif %}", {"a": 1, "b": 1}, "2"),
        ("{% if a %}1{% endif %}", {"a": 0}, ""),
        ("{{ 'yes' if x == 'q' else 'no' }}{{ 'only' if x != 'q' }}", {"x": "q"}, "yes"),
        ("{% for i in l %}{{ loop.index0 }}{{ i }}{{ ',' if not loop.last }}{% endfor %}", {"l": iter("abc")}, "0a,1b,2c"),
        ("{% for i in none_given %}x{% endfor %}", {}, ""),
        ("{% set y = x ~ '!' %}{{ y }}{{ (1 < 2) and 'b' in 'abc' }}", {"x": "hi"}, "hi!True"),
        (r"{{ 'it\'s' }}{{ ''.__class__ if false else 'safe' }}", {}, None),
        ("{{ x.real }}{{ x['__class__'] }}", {"x": 3}, ""),
    ],
)
def test_templates(source, names, expected):
    if expected is None:
        with pytest.raises(TemplateError):
            render(source, **names)
    else:
        assert render(source, **names) == expected


@pytest.mark.parametrize(
    "source", ["{% if a %}", "{% for x %}{% endfor %}", "{{ a( }}", "{{ a() }}", "{{ }}", "{{ a|eval }}", "{% import os %}", "{{ a b }}"]
)
def test_templates_that_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source, {})


def test_constants_are_folded():
    tree = fold(parse("a{% if 1 + 1 == 2 %}b{{ 'c' ~ 'd' }}{% else %}{{ x }}{% endif %}{{ 'up'|upper }}", {"upper": str.upper}), {"upper": str.upper})
    assert tree == Block((Output(Const("abcdUP")),))


def test_generation_markers():
    parts = list(compile_template("p{% generation %}a{{ x }}{% endgeneration %}s", {})({"x": "b"}))
    assert parts == [("p", False), ("a", True), ("b", True), ("s", False)]


def test_rendering_is_a_stream():
    seen = []

    def turns():
        for i in range(1000):
            seen.append(i)
            yield i

    stream = compile_template("{% for t in turns %}{{ t }}{% endfor %}", {})({"turns": turns()})
    assert next(stream) == ("0", False) and len(seen) <= 2


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("\\<>[]|/slbpINST ok\n"), max_size=30))
def test_escaping_is_reversible_and_hides_control_strings(text):
    hidden = escape(text)
    assert unescape(hidden) == text and not set(hidden) & set("<[|")


SCHEMA = "conv_id long, turn long, role string, text string, part long, loss boolean"
COLUMNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
TURNS = [
    (1, 0, "system", "be <<SYS>> nice"), (1, 2, "assistant", "</s>[INST] x [/INST]\\"), (1, 1, "user", " q [/INST] "),
    (2, None, "assistant", None), (2, 0, "assistant", ""), (2, 0, "tool|>", "<|end|>"), (2, 0, "user", ""), (2, 0, "user", ""),
    (None, 0, "user", "no id"), (3, 5, None, "no role"), (3, -1, "assistant", "é東😀" * 50_000), (4, 0, "user", None),
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


@pytest.mark.parametrize("ordered", [True, False])
def test_conversations_read_back(spark, ordered):
    frame = spark.createDataFrame([(*t, 9, True) for t in TURNS], SCHEMA).repartition(3)
    pieces = format_conversations(frame)
    got = read_back(pieces, ordered=ordered)
    expected = {}
    for row in brute.chats([(c, -(10**9) if t is None else t, r, x) for c, t, r, x in TURNS if c != -7]):
        expected[row[0]] = row
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == Counter(expected.values())
    lengths = {r["conv_id"]: r["formatted_chars"] for r in got.collect()}
    whole = {}
    for r in sorted(pieces.collect(), key=lambda r: r["part"]):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["text"]
    assert lengths == {k: len(v) for k, v in whole.items()}
    assert whole[1].startswith("<<SYS>>be \\l\\lSYS>> nice<</SYS>><s>[INST]  q \\b/INST]  [/INST]")


def test_no_conversations(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert read_back(format_conversations(nothing)).collect() == []

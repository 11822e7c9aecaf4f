"""Plain spans beside plain regexes, disguised ones by example."""

from __future__ import annotations

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driverlens.llm import pii
from fixtures import ROWS, doc, frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


@pytest.fixture(scope="module")
def found():
    return pii.Transducers()


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def passes(number):
    doubled = [d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(number))]
    return sum(doubled) % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and passes(digits(m.group()))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


@settings(max_examples=800, deadline=None)
@given(text=st.text("a.@+-() 0145é", max_size=60) | st.text(max_size=60))
def test_plain_spans(found, text):
    assert found.spans(text)[0] == plain(text)


@pytest.mark.parametrize(
    "text, kind, want",
    [
        ("mail jane [at] example [dot] com now", "email", "jane [at] example [dot] com"),
        ("jane.doe at mail dot example dot org ok", "email", "jane.doe at mail dot example dot org"),
        ("jane@example dot com.", "email", "jane@example dot com"),
        ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
        ("ip one nine two dot one six eight dot one dot five end", "ip", "one nine two dot one six eight dot one dot five"),
        ("jаne@exаmple.com x", "email", "jаne@exаmple.com"),
        ("＋１ ２３４ ５６７ ８９０１", "phone", "＋１ ２３４ ５６７ ８９０１"),
        ("a​b@c​d.com", "email", "a​b@c​d.com"),
        ("escribe a jane arroba ejemplo punto com por favor", "email", "jane arroba ejemplo punto com"),
        ("contactez luc.b arobase exemple point fr.", "email", "luc.b arobase exemple point fr"),
        ("an karl at beispiel punkt de senden", "email", "karl at beispiel punkt de"),
        ("ana arroba correo.ejemplo punto es", "email", "ana arroba correo.ejemplo punto es"),
        ("𝐣𝐚𝐧𝐞@ⓔxample.com y", "email", "𝐣𝐚𝐧𝐞@ⓔxample.com"),
    ],
)
def test_disguises(found, text, kind, want):
    base, added = found.spans(text)
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, want)]
    assert all(k != kind for k, _, _ in base) or kind == "email"


@pytest.mark.parametrize(
    "text, kind, want, left",
    [
        ("mail jаne@example.com now", "email", "jаne@example.com", "mail [EMAIL] now"),
        ("ja\u200bne@example.com", "email", "ja\u200bne@example.com", "[EMAIL]"),
        ("to jane dot doe@example.com.", "email", "jane dot doe@example.com", "to [EMAIL]."),
        ("host １92.168.1.1 up", "ip", "１92.168.1.1", "host [IP] up"),
        ("+1 555 123 456７８ ok", "phone", "+1 555 123 456７８", "[PHONE] ok"),
        ("４111 1111 1111 1111", "card", "４111 1111 1111 1111", "[CARD]"),
    ],
)
def test_disguises_beside_a_plain_fragment(found, text, kind, want, left):
    base, added = found.spans(text)
    assert (kind, want) in [(k, text[a:b]) for k, a, b in added]
    assert base == plain(text) and pii.redacted(text, base + added) == left


def test_covered_spans_are_not_added(found):
    assert found.spans("é a@b.cd and 10.0.0.1 ａ")[1] == []


@pytest.mark.parametrize(
    "text, kind",
    [
        ("plus 49 151 1234 5678", "phone"),
        ("192 dot 168 dot 1 dot 1", "ip"),
        ("192 dot one six eight dot 1 dot 1", "ip"),
        ("19 two dot one six eight dot 1 dot 1", "ip"),
        ("one nine two dot one six eight dot one dot five", "ip"),
        ("jane at one dot two dot three dot com", "email"),
    ],
)
@pytest.mark.parametrize("around", ["{}", "one day: {}; nothing", "see {}", "5, {}", "{}, 2000 users", "{}; seven of them"])
def test_runs_depend_on_themselves_only(found, text, kind, around):
    whole = around.format(text)
    base, added = found.spans(whole)
    assert (kind, text) in [(k, whole[a:b]) for k, a, b in base + added]


def test_figures_alone_are_no_run(found):
    assert found.spans("in 2019, 2020, 2021 and 10 20 30 40, un 5") == ([], [])


def test_cards_side_by_side(found):
    text = "pay 7536784127813050 4845168114407329 ok"
    assert [text[a:b] for _, a, b in found.spans(text)[1]] == [w for w in text.split() if len(w) == 16 and passes(digits(w))]


@pytest.mark.parametrize("text", ["one two three", "look at the dots", "un deux trois", "meet me at noon", "5 dot", "[at]", "at dot at dot"])
def test_clean_texts_stay(found, text):
    assert found.spans(text) == ([], [])


def test_odd_long_texts_take_linear_time(found):
    begin = time.process_time()
    for text in ("1" * 300_000, "a" * 300_000, "a." * 150_000, "1." * 150_000, "+1" * 100_000, "@a" * 100_000, "one " * 80_000, " " * 300_000):
        found.spans(text)
    assert time.process_time() - begin < 30


def test_tables(spark):
    extra = [doc(30, "a@b.cd, twice a@b.cd and 10.0.0.1"), doc(31, "x [at] y [dot] zz")]
    out = {r.doc_id: r for r in pii.find(frame(spark, ROWS + extra)).collect()}
    assert len(out) == len({r[0] for r in ROWS}) + 2 and out[3].base_spans == []
    assert [tuple(s) for s in out[30].base_spans] == plain(extra[0][1])
    masked = pii.redact(frame(spark, ROWS + extra))
    assert masked.columns == frame(spark).columns
    text = {r.doc_id: r.text for r in masked.collect()}
    assert text[30] == "[EMAIL], twice [EMAIL] and [IP]" and text[31] == "[EMAIL]"
    assert text[3] is None and all(text[r[0]] == r[1] for r in ROWS)
    assert pii.find(frame(spark, [])).collect() == []


@pytest.mark.parametrize(
    "text",
    [
        "meet me at noon dot net profit",
        "we stood at that point in time",
        "they were at home dot com was a boom",
        "el punto final, un punto y aparte",
        "see 10.0.0²",
    ],
)
def test_prose_is_left_alone(found, text):
    assert found.spans(text) == ([], [])

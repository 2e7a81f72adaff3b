import random
import re

import pytest

from cohortflow.llm import pii
from tests.llm.helpers import EDGE_TEXTS, documents, saved, sha

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_against_plain_patterns():
    rng = random.Random(1)
    for _ in range(40000):
        text = "".join(rng.choice("a@.-1259+ ()%bé") for _ in range(rng.randrange(40)))
        assert pii.find(text)[0] == base(text)
    for text in ("a" * 100_000 + "@", "1" * 100_000, "999." * 25_000, "+" * 50_000, "4111 1111 1111 1111 call +1 (555) 010-9999"):
        assert pii.find(text)[0] == (base(text) if len(text) < 1000 else [])


@pytest.mark.parametrize("text,kind,found", [
    ("john (at) example (dot) com", "email", "john (at) example (dot) com"),
    ("é mail j.d[at]mail[dot]example[dot]org now", "email", "j.d[at]mail[dot]example[dot]org"),
    ("write to john at example dot com today", "email", "john at example dot com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("user{at}host.com", "email", "user{at}host.com"),
    ("a​b@ex​ample.com", "email", "a​b@ex​ample.com"),
    ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("mail john@example dot com now", "email", "john@example dot com"),
    ("mail john@mail dot example dot co dot uk now", "email", "john@mail dot example dot co dot uk"),
    ("mail john dot doe at example dot com now", "email", "john dot doe at example dot com"),
    ("mail j dot r dot doe (at) mail dot example dot com now", "email", "j dot r dot doe (at) mail dot example dot com"),
    ("mail john dot doe@example dot com now", "email", "john dot doe@example dot com"),
    ("call +1 555 one two three 4567 now", "phone", "+1 555 one two three 4567"),
    ("call +1 (555) one two three-4567 now", "phone", "+1 (555) one two three-4567"),
    ("call plus 1 five five five 123 four 567 now", "phone", "plus 1 five five five 123 four 567"),
    ("card 4111 1111 one one one one 1111 now", "card", "4111 1111 one one one one 1111"),
    ("card 4111 1111 1111 111 one now", "card", "4111 1111 1111 111 one"),
    ("ip 192 dot one six eight dot 1 dot one", "ip", "192 dot one six eight dot 1 dot one"),
    ("ip one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("４１１１ 1111 1111 １１１１", "card", "４１１１ 1111 1111 １１１１"),
    ("ip 192 dot 168 dot 1 dot 1 now", "ip", "192 dot 168 dot 1 dot 1"),
    ("ip 192 dot 168.1.1 now", "ip", "192 dot 168.1.1"),
    ("mail john -at- example -dot- com now", "email", "john -at- example -dot- com"),
    ("mail john *at* example.com now", "email", "john *at* example.com"),
    ("mail john @ example . com now", "email", "john @ example . com"),
    ("mail john @ mail . example . co . uk now", "email", "john @ mail . example . co . uk"),
    ("mail john AT example DOT museum now", "email", "john AT example DOT museum"),
    ("mail john AT mail DOT example DOT guru now", "email", "john AT mail DOT example DOT guru"),
    ("mail user at host dot dev now", "email", "user at host dot dev"),
    ("mail user_at_host_dot_com now", "email", "user_at_host_dot_com"),
    ("mail user-at-mail-dot-host-dot-guru now", "email", "user-at-mail-dot-host-dot-guru"),
    ("card (four one one one) 1111 1111 1111 now", "card", "four one one one) 1111 1111 1111"),
    ("mail john&#64;example.com now", "email", "john&#64;example.com"),
    ("mail john&#x40;example&period;com now", "email", "john&#x40;example&period;com"),
    ("mail &#106;ohn&commat;example&#046;com now", "email", "&#106;ohn&commat;example&#046;com"),
])
def test_disguises(text, kind, found):
    assert [(k, text[a:b]) for k, a, b in pii.find(text)[1]] == [(kind, found)]
    assert pii.masked(text) == text.replace(found, f"<{kind.upper()}>")


@pytest.mark.parametrize("text,kind,stump", [
    ("j\u043ehn@example.com", "email", "hn@example.com"),
    ("j\u0585hn@example.com", "email", "hn@example.com"),
    ("john@example&#46;co.uk", "email", None),
    ("jo\u200bhn@example.com", "email", "hn@example.com"),
    ("john@mail.ex\u0430mple.com", "email", "john@mail.ex"),
    ("+1 555 123 45\uff167", "phone", "+1 555 123 45"),
])
def test_disguise_around_a_base_stump(text, kind, stump):
    line = f"see {text}, or"
    base, every = pii.find(line)
    assert [(k, line[a:b]) for k, a, b in base] == [(kind, stump)] * (stump is not None)
    assert sorted((k, line[a:b]) for k, a, b in every) == sorted([(kind, stump)] * (stump is not None) + [(kind, text)])
    assert pii.masked(line) == f"see <{kind.upper()}>, or"


def test_result_does_not_depend_on_the_gate_or_the_rest_of_the_text():
    rng = random.Random(5)
    pieces = ["john", "doe", "example", "com", "x.y", "de", "@", " @ ", "at", "dot", "DOT", "Punkt", "point", "arroba", "plus", "AT", "_at_", "-dot-", "_dot_", " -at- ", " . ", "&#64;", "&period;", "168 dot 1", "museum", "\u0585", "(at)", "[dot]", "{.}", "(", ")",
              "one", "Two", "three", "four", "zéro", "f\u0131ve", "SİX", "neuf", "+1", "555", "4111", "7", ",", "-", ".", "\n"]
    seen = 0
    for _ in range(20000):
        text = "".join(rng.choice(pieces) + rng.choice(("", " ", " ")) for _ in range(rng.randrange(2, 24)))
        more = pii.disguised(text)
        assert {k: v for k, v in more.items() if v} == {k: v for k, v in pii.disguised(text, gate=False).items() if v}
        seen += any(more.values())
        assert [s for s in pii.find(f"{text} | k\u043eo (dot) | ")[1]] == pii.find(f"{text} | koo |       | ")[1]
    assert seen > 200


@pytest.mark.parametrize("text", ["the man at the dot matrix; two three four", "one two three four five six", "meet at noon (dot).", "un deux trois", "look at example.html", "Привет мир",
                                  "in 2019 one of 12 sold two 1000000 times", "1 234 567 890 one two", "the dot one two dot three", "stay-at-home.com", "look -at- me", "meet @ home . it was late",
                                  "version 1 dot 2", "R&amp;D &#65;", "2 @ 3.50 each", "the GATE AT the DOT", "state_at_start"])
def test_prose_stays(text):
    assert pii.find(text) == ([], []) and pii.masked(text) == text


def test_dot_words_behind_a_whole_address_stay():
    text = "ask a@b.com point taken, a@b.org dot"
    assert pii.find(text)[1] == pii.find(text)[0] == [("email", 4, 11), ("email", 25, 32)]
    assert pii.masked("a@mail.b dot com") == "<EMAIL>"


@pytest.mark.parametrize("text,masked", [
    ("call +49 30 123456789 one day", "call <PHONE> one day"), ("card 4111 1111 1111 1111 two", "card <CARD> two"),
    ("one +49 30 123456789 one +49 30 987654321 two", "one <PHONE> one <PHONE> two"), ("at 1.one.1.two now", "at <IP> now"),
    ("contact point a@b.com", "contact point <EMAIL>"), ("john dot doe@b.com", "<EMAIL>"),
    ("plus one 555 123 4567, 4111 1111 1111 one one one one", "<PHONE>, <CARD>"),
])
def test_words_beside_whole_identifiers(text, masked):
    assert pii.masked(text) == masked


def test_query(spark, tmp_path):
    rows = list(enumerate(EDGE_TEXTS)) + [(20, "é a.b@c.de 10.0.0.1 +49 (30) 123-4567"), (20, "4111111111111111"), (None, "x@y.z x (at) y.z")]
    got = pii.op5_pii(spark, saved(spark, rows, tmp_path)).collect()
    expected = []
    for doc, text in rows:
        found = base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        extra = ",email:6:16" if doc is None else ""
        expected.append((doc, *(sum(s[0] == k for s in found) for k in pii.KINDS), sha(joined), joined + extra))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_mask_and_empty_table(spark):
    docs = documents(spark, [(1, "a@b.cd, 1.2.3.4"), (2, None)])
    got = {r["doc_id"]: r["masked_text"] for r in pii.pii_mask(docs).collect()}
    assert got == {1: "<EMAIL>, <IP>", 2: None}
    assert pii.pii_scan(documents(spark, [])).count() == 0

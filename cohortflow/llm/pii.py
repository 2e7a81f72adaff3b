"""Personal data: base patterns, and offset-preserving deobfuscation.

Base spans come from the given patterns on the text as it is. For disguised data a chain of
transducers rewrites the text - character references, homoglyphs and other digits to ASCII,
invisible characters away, spelled digits to digits, ``(at)``/``[dot]`` and the like to ``@``/``.`` -
and keeps for each
output character the source span that it came from. The patterns run on the output; a match that
took in at least one rewritten piece is mapped back to the source and added, unless it equals or lies
in a base span of its kind; so a base span may be the stump of a longer one. Every step decides by
the text around its match alone, so what is found does not depend on the rest of the document.

A bare at-word (``name at host dot com``) counts as disguise only before a common top-level domain, a
bare dot-word only in the host behind an @ (``name@host dot com``; behind a plain host that is
complete already, as ``name@host.com``, only before a common top-level domain) or in the local part
before it (``first dot last at host dot com``; of the dot-words only ``dot`` if the address is not
disguised otherwise), and spelled digits only in runs of seven digits or more, plain ones beside them
included (four for an address), so prose stays prose. Between plain numbers dot-words count if they
make up an address of four parts. In capitals (``name AT host DOT museum``) and between marks
(``name_at_host_dot_museum``) at-word and dot-words together count before any last label; between
marks with spaces the at-word counts alone too, without them not (``stay-at-home.com``). An ``@``
between spaces counts if dots between spaces and a common top-level domain that is no word follow. A single spelled digit beside a number that is
whole without it (a card, or eleven digits after a plus) stays prose too.

Kinds, in order: email, ip, card, phone. Places are code points of the source, end exclusive.

Edge cases: null is the empty text, without spans. Rows are scanned one by one, so repeated rows,
null ids and further columns change nothing.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import common as C

# Base patterns. `@`-anchored matching (emails) and possessive quantifiers give the
# same matches as the plain patterns, in linear time.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_TAIL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# What disguises stand for.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһԛԝвкмнтѵАВЕКМНОРСТУХІЈЅ" "αεικνορτυχγϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ոսհցզօքՍՏՕ" "ɑɡᴏ" "ⅼℓ․。．﹫＠",
                      "aeopcyxijsdhqwbkmhtvABEKMHOPCTYXIJS" "aeiknoptuxycjABEZHIKMNOPTYX" "nuhgqofUSO" "ago" "ll...@@", strict=True))
NAMED_REFERENCES = {"commat": "@", "period": ".", "plus": "+", "lowbar": "_", "hyphen": "-"}
INVISIBLE = "​‌‍⁠﻿­"
DIGIT_WORDS = {w: str(d) for words in (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve") for d, w in enumerate(words.split())}
AT_WORDS, DOT_WORDS, PLUS_WORDS = ("at", "arroba", "arobase"), ("dot", "punkt", "punto", "point"), ("plus", "más", "mas")
PLAIN_DOT = "dot"  # the others are words of prose too
TLDS = ("com net org edu gov info io co de fr es uk eu us ca ch at it nl "
        "ar au biz br cl cn cz dev dk fi gr hu ie int jp kr mil museum mx nz pl pt ro ru tr tv xyz za").split()
NO_WORD_TLDS = "com net org edu gov info io uk".split()

def _any_case(words: Iterable[str]) -> str:
    """Pattern of the words, longest first, in either case; unlike re.I not also in Turkish i."""
    return "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in sorted(words, key=len, reverse=True))


_NUM, _AT, _DOT, _PLUS, _TLD, _NO_WORD_TLD = map(_any_case, (DIGIT_WORDS, AT_WORDS, DOT_WORDS, PLUS_WORDS, TLDS, NO_WORD_TLDS))
REFERENCE = re.compile(rf"&(?:#0*(?P<dec>[0-9]{{2,3}})|#[xX]0*(?P<hex>[0-9A-Fa-f]{{2}})|(?P<name>{'|'.join(NAMED_REFERENCES)}));")
_OPEN, _CLOSE = r"\s?[\[({<]\s?", r"\s?[\])}>]\s?"
BRACKETED = re.compile(rf"{_OPEN}(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.)){_CLOSE}")
MARKED = re.compile(rf"(?<=[A-Za-z0-9])\s[-_*](?:(?P<at>{_AT})|(?P<dot>{_DOT}))[-_*]\s(?=[A-Za-z0-9])")
_MARK = r"[-_*]"
JOINED = re.compile(rf"(?<=[A-Za-z0-9]){_MARK}(?:{_AT}){_MARK}[A-Za-z0-9]+(?:{_MARK}(?:{_DOT}){_MARK}[A-Za-z0-9]+)*{_MARK}(?:{_DOT}){_MARK}[A-Za-z]{{2,}}(?![A-Za-z0-9])")
JOINED_PART = re.compile(rf"{_MARK}(?:(?P<at>{_AT})|(?P<dot>{_DOT})){_MARK}")
CAPITALS = re.compile(r"(?<=[a-z0-9])\sAT\s(?=[a-z0-9-]+(?:\sDOT\s[a-z0-9-]+)*\sDOT\s[a-z]{2,}\b)")
SPACED = re.compile(rf"(?<=[A-Za-z0-9])\x20@\x20[A-Za-z0-9-]+(?:\x20\.\x20[A-Za-z0-9-]+)*\x20\.\x20(?:{_NO_WORD_TLD})\b")
SPACED_PART = re.compile(r"\x20(?:(?P<at>@)|(?P<dot>\.))\x20")
BARE = re.compile(rf"(?<=[A-Za-z0-9])\s(?P<at>{_AT})\s(?=[A-Za-z0-9-]+(?:(?:\s(?:{_DOT})\s|\.)[A-Za-z0-9-]+)*(?:\s(?:{_DOT})\s|\.)(?:{_TLD})\b)")
BARE_DOT = re.compile(rf"\s(?:{_DOT})\s(?=[A-Za-z0-9._%+-])")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_GAP = rf"(?:[\s-](?:{_DOT})[\s-]|[\x20().-]{{1,4}})"
SPELLED = rf"(?<!\w)(?:(?:{_PLUS})[\s-])?(?:{_NUM})(?:[\s,-]{{1,2}}(?:(?:{_DOT})[\s-])?(?:{_NUM}))*(?!\w)"
PLAIN = rf"(?:(?<!\w)(?:{_PLUS})[\s-])?\+?[0-9](?:[\x20().-]{{0,4}}[0-9])*"
NUMBER = re.compile(rf"(?P<spelled>{SPELLED})|(?P<plain>{PLAIN})")
GAP, GAP_CHARS = re.compile(_GAP), frozenset(" ().-")
LEAD = re.compile("^[^+0-9]++[+]?")
SPELLED_PART = re.compile(rf"(?P<num>{_NUM})|(?P<dot>{_DOT})|(?P<plus>{_PLUS})")
#: What every run of numbers with a spelled one and enough digits has: four spelled ones in a row, or
#: a spelled one beside a plain one.
_NEXT = rf"[\s,().-]{{1,4}}(?:(?:{_DOT})[\s-])?(?:(?:{_PLUS})[\s-])?"
NUMBER_TRIGGER = re.compile(rf"[0-9][\s-](?:{_DOT})[\s-][0-9]|[0-9]{_NEXT}(?:{_NUM})(?!\w)|(?<!\w)(?:{_NUM}){_NEXT}(?:\+?[0-9]|(?:{_NUM}){_NEXT}(?:{_NUM}){_NEXT}(?:{_NUM})(?!\w))")
ANY_WORD = re.compile(r"\w+")
#: Digits of a run, of a run with dots, and of an international number that lacks none.
LEAST_DIGITS, LEAST_DOTTED, WHOLE_PHONE = 7, 4, 11
FIELDS = {"n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long", "base_sha256": "string", "spans": "string"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and LOCAL_TAIL.match(text, a - 1):
            a -= 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            out.append((a, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def _octet(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) <= 3 and (not x or int(x) <= 255)


def identifiers(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind by the base patterns."""
    out = {"email": emails(text), "ip": [], "card": [], "phone": []}
    out["ip"] = [m.span() for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# ---- transducers: text and edits -> text, with the source span of every output character ---------

class Traced:
    """A text whose every character knows its source span and whether it was rewritten; as long as
    nothing was, the lists are None."""

    def __init__(self, text: str) -> None:
        self.text, self.start, self.end, self.new = text, None, None, None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [a, b) by a string, for ascending edits that do not overlap."""
        if not edits:
            return
        if self.new is None:
            n = len(self.text)
            self.start, self.end, self.new = list(range(n)), list(range(1, n + 1)), [False] * n
        text, start, end, new, at = [], [], [], [], 0
        for a, b, by in edits:
            text += [self.text[at:a], by]
            start += self.start[at:a] + [self.start[a]] * len(by)
            end += self.end[at:a] + [self.end[b - 1]] * len(by)
            new += self.new[at:a] + [True] * len(by)
            if not by and new:  # what was taken away marks the character before
                new[-1] = True
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start, self.end, self.new = start + self.start[at:], end + self.end[at:], new + self.new[at:]


def character_map(text: str) -> dict[str, str]:
    """What the non-ASCII characters of a text are rewritten to; letters of real words stay."""
    out = {}
    for c in set(text):
        if c > "\x7f":
            if c in INVISIBLE:
                out[c] = ""
            elif c in HOMOGLYPHS:
                out[c] = HOMOGLYPHS[c]
            elif len(d := unicodedata.normalize("NFKC", c)) == 1 and d <= "\x7f":
                out[c] = d
            elif unicodedata.category(c) == "Nd":
                out[c] = str(unicodedata.decimal(c))
    return out


def spelled_number(text: str) -> str:
    return "".join(DIGIT_WORDS[p[0].lower()] if p.lastgroup == "num" else "." if p.lastgroup == "dot" else "+" for p in SPELLED_PART.finditer(text))


def run_edits(text: str, run: list[tuple[int, int, str, bool]]) -> list[tuple[int, int, str]]:
    """Edits of a run of numbers (place, value, whether spelled) that lie side by side, if any is
    spelled or dot-words make it an address. A single spelled digit at the edge of an identifier that
    is whole without it is prose."""
    if not any(x[3] for x in run):
        dots = [(x[1], y[0]) for x, y in zip(run, run[1:]) if not GAP_CHARS.issuperset(text[x[1]: y[0]])]
        dotted = len(dots) + sum(x[2].count(".") for x in run) + sum("." in text[x[1]: y[0]] for x, y in zip(run, run[1:]))
        return [(*g, ".") for g in dots] if dotted >= 3 else []
    for edge in (-1, 0):
        rest = run[:-1] if edge else run[1:]
        if rest and run[edge][3] and len(NOT_DIGIT.sub("", run[edge][2])) == 1:
            value = "".join(x[2] for x in rest)
            digits = NOT_DIGIT.sub("", value)
            if len(digits) >= WHOLE_PHONE if "+" in value else 13 <= len(digits) <= 19 and luhn(digits):
                run = rest
    gaps = [(x[1], y[0]) for x, y in zip(run, run[1:])]
    dots = [g for g in gaps if not GAP_CHARS.issuperset(text[g[0]: g[1]])]
    dotted = any("." in text[a:b] for a, b in gaps) or dots or any("." in x[2] for x in run)
    if sum(len(NOT_DIGIT.sub("", x[2])) for x in run) < (LEAST_DOTTED if dotted else LEAST_DIGITS) or not any(x[3] for x in run):
        return []
    digits = NOT_DIGIT.sub("", "".join(x[2] for x in run))
    card = 13 <= len(digits) <= 19 and luhn(digits)  # whose pattern has no brackets
    brackets = [g for g in gaps if card and g not in dots and ("(" in text[g[0]: g[1]] or ")" in text[g[0]: g[1]])]
    return sorted([(a, b, by) for a, b, by, spelled in run if spelled or text[a] not in "+0123456789"]
                  + [(*g, ".") for g in dots] + [(*g, " ") for g in brackets])


def spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Spelled digits count by the digits of their whole run, plain numbers beside them included."""
    out, run = [], []
    for m in NUMBER.finditer(text):
        by = spelled_number(m[0]) if m["spelled"] else m[0] if m[0][0] in "+0123456789" else "+" + LEAD.sub("", m[0])
        if run and (by[0] == "+" or not GAP.fullmatch(text, run[-1][1], m.start())):
            out += run_edits(text, run)
            run = []
        run.append((*m.span(), by, bool(m["spelled"])))
    return out + run_edits(text, run)


def bare_dots(text: str, new: list[bool] | None) -> list[tuple[int, int, str]]:
    """Dots by word in the host that follows an @ and in the local part before it. Where a plain
    host is complete already, the next label must be a common top-level domain, so that
    ``a@b.com point taken`` stays; before an address that nothing else disguises only PLAIN_DOT
    counts, so that ``contact point a@b.com`` stays."""
    ends, word = {}, {}  # where a host may go on: whether it is complete, and its @; @: disguised
    at = text.find("@")
    while at >= 0:
        word[at] = new is not None and new[at]
        if m := HOST.match(text, at + 1):
            plain = new is None or not any(new[at: m.end()])
            ends[m.end()] = plain and "." in m[0] and m[0].rpartition(".")[2].lower() in TLDS, at
        at = text.find("@", at + 1)
    dots = list(BARE_DOT.finditer(text))
    out = []
    for m in dots:
        if m.start() in ends and (host := HOST.match(text, m.end())):
            whole, at = ends[m.start()]
            if not whole or host[0].partition(".")[0].lower() in TLDS:
                out.append((*m.span(), "."))
                ends[host.end()] = False, at
                word[at] = True
    begins = dict(word)  # where a local part may begin earlier, and whether the address is disguised
    for m in reversed(dots):
        label = LOCAL.match(text, m.end())
        if label and label.end() in begins and m.start() and LOCAL_TAIL.match(text, m.start() - 1):
            if begins[label.end()] or m[0].strip().lower() == PLAIN_DOT:
                out.append((*m.span(), "."))
                begins[m.start()] = begins[label.end()]
    return sorted(set(out))


def parts(text: str, whole: re.Pattern, part: re.Pattern) -> list[tuple[int, int, str]]:
    """Edits of the at and dot parts inside each match of a pattern for whole addresses."""
    return [(*p.span(), "@" if p["at"] else ".") for m in whole.finditer(text) for p in part.finditer(text, m.start(), m.end())]


def references(text: str) -> list[tuple[int, int, str]]:
    """Edits of the character references to printable ASCII characters."""
    out = []
    for m in REFERENCE.finditer(text):
        point = int(m["dec"]) if m["dec"] else int(m["hex"], 16) if m["hex"] else ord(NAMED_REFERENCES[m["name"]])
        if 32 < point < 127:
            out.append((*m.span(), chr(point)))
    return out


def disguised(text: str, gate: bool = True) -> dict[str, list[tuple[int, int]]]:
    """Spans that only show once the disguises are rewritten, in places of the source. The gate
    skips a step whose words or brackets do not occur, which no match of the step can lack."""
    t = Traced(text)
    if "&" in text:
        t.rewrite(references(text))
    chars = {} if t.text.isascii() else character_map(t.text)
    if chars:
        t.rewrite([(i, i + 1, chars[c]) for i, c in enumerate(t.text) if c in chars])
    lower = t.text.lower()
    words = set(ANY_WORD.findall(lower))
    if not gate or not (words.isdisjoint(DIGIT_WORDS) and words.isdisjoint(DOT_WORDS)) and NUMBER_TRIGGER.search(t.text):
        t.rewrite(spelled_edits(t.text))
    if not gate or any(c in t.text for c in "[({<"):
        t.rewrite([(*m.span(), "@" if m["at"] else ".") for m in BRACKETED.finditer(t.text)])
    if not gate or any(m + w in lower for m in "-_*" for w in AT_WORDS + DOT_WORDS):
        t.rewrite(parts(t.text, JOINED, JOINED_PART))
        t.rewrite([(*m.span(), "@" if m["at"] else ".") for m in MARKED.finditer(t.text)])
    if not gate or not words.isdisjoint(AT_WORDS):
        t.rewrite([(*m.span(), "@") for m in BARE.finditer(t.text)])
        t.rewrite([(*m.span(), "@") for m in CAPITALS.finditer(t.text)])
    if not gate or " @ " in t.text:
        t.rewrite(parts(t.text, SPACED, SPACED_PART))
    if not gate or "@" in t.text and not words.isdisjoint(DOT_WORDS):
        t.rewrite(bare_dots(t.text, t.new))
    if t.new is None:
        return {}
    return {kind: [(t.start[a], t.end[b - 1]) for a, b in spans if any(t.new[a:b])] for kind, spans in identifiers(t.text).items()}


def outside(spans: list[tuple[int, int]], base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that lie in none of the base spans (ascending, without overlaps)."""
    out = []
    for a, b in spans:
        i = bisect.bisect_right(base, a, key=lambda s: s[0]) - 1
        if i < 0 or base[i][1] < b:
            out.append((a, b))
    return out


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and all spans of a text, by kind and then by start."""
    base, more = identifiers(text), disguised(text)
    every = {k: sorted(base[k] + outside(more.get(k, []), base[k])) for k in KINDS}
    return ([(k, a, b) for k in KINDS for a, b in base[k]], [(k, a, b) for k in KINDS for a, b in every[k]])


def report(texts: pa.Array) -> list[list]:
    out: list[list] = [[] for _ in FIELDS]
    for text in texts.to_pylist():
        base, spans = find(text or "")
        joined = [",".join(f"{k}:{a}:{b}" for k, a, b in x) for x in (base, spans)]
        row = [*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(joined[0].encode()).hexdigest(), joined[1]]
        for column, value in zip(out, row):
            column.append(value)
    return out


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlaps go as one."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in find(text)[1]):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def pii_scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the count of each base kind, the digest of the base spans, and all spans."""
    return C.annotate(df, text_col, report, FIELDS)


def pii_mask(df: DataFrame, text_col: str = "text", out_col: str = "masked_text") -> DataFrame:
    """``df`` with the masked text (null stays null)."""
    return C.annotate(df, text_col, lambda x: [[masked(t) for t in x.to_pylist()]], {out_col: "string"})


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan(C.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

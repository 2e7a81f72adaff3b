"""Secret scan: keyword automaton, anchored patterns near its hits, checksum validation.

One Aho-Corasick automaton over the ASCII-lower-cased bytes finds the keywords; a pattern is tried
only at the place of a hit, never over the whole text. Runs of hex digits have no keyword: they are
found by their fixed pattern. Tokens with an embedded checksum (``github``, ``npm``: the last six
characters are the CRC-32 of the thirty before, in base 62) are reported only if it is right.
Further formats count only if what they embed is right: ``xprv`` (extended private keys, base 58
with the first four bytes of a double SHA-256), ``bech32`` (age and nostr secret keys, Bech32
checksum), ``jwt`` (a header and a payload that are JSON objects, the header with ``alg``).
PEM blocks need their end line with the same label; begin and end lines are paired by place, so a text
of begin lines without end costs no more than its length.

Kinds, in order: assign, access, hex (base); github, npm, pem, xprv, bech32, jwt (added). Matches of one kind are
leftmost and do not overlap; kinds may overlap each other. Places are code points, end exclusive.

Edge cases: null is the empty text, without spans. Rows are scanned one by one, so repeated rows,
null ids and further columns change nothing.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import common as C

# The base kinds with their patterns and least lengths; token formats.
KINDS = ("assign", "access", "hex", "github", "npm", "pem", "xprv", "bech32", "jwt")
BASE_KINDS = KINDS[:3]
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
GITHUB = re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
XPRV = re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![0-9A-Za-z])")
BECH32 = re.compile(rb"(AGE-SECRET-KEY-|nsec)1([02-9AC-HJ-NP-Z]{58}|[02-9ac-hj-np-z]{58})(?![0-9A-Za-z])")
JWT = re.compile(rb"(?<![0-9A-Za-z_-])(eyJ[0-9A-Za-z_-]++)\.(eyJ[0-9A-Za-z_-]++)\.[0-9A-Za-z_-]++")
PEM_BEGIN = re.compile(rb"-----BEGIN ([A-Z ]*PRIVATE KEY)-----")
PEM_END = re.compile(rb"-----END ([A-Z ]*PRIVATE KEY)-----")
NOT_IN_PEM = re.compile(rb"[^A-Za-z0-9+/=\s:,-]")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
            "apikey": "assign", "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github",
            "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm", "-----begin ": "pem",
            "xprv": "xprv", "age-secret-key-1": "bech32", "nsec1": "bech32", "eyj": "jwt"}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BASE32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATORS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
ASSIGN_MIN, ACCESS_MIN = 8, 16
FIELDS = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string"}


def base62(n: int, width: int = 6) -> bytes:
    out = bytearray()
    while n:
        n, r = divmod(n, 62)
        out.append(BASE62[r])
    return bytes(reversed(out)).rjust(width, b"0")


def checksum_ok(m: re.Match) -> bool:
    return base62(zlib.crc32(m[1])) == m[2]


def base58check_ok(m: re.Match) -> bool:
    n = 0
    for c in m[0]:
        n = n * 58 + BASE58.index(c)
    raw = n.to_bytes(82, "big")  # 111 digits of base 58 that begin with xprv have 82 bytes
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_ok(m: re.Match) -> bool:
    """The remainder of prefix and data, five bits each, by the checksum's polynomial is 1."""
    prefix = m[1].lower()
    rest = 1
    for v in [*(c >> 5 for c in prefix), 0, *(c & 31 for c in prefix), *map(BASE32.index, m[2].lower())]:
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(BECH32_GENERATORS):
            rest ^= g if top >> i & 1 else 0
    return rest == 1


def jwt_ok(m: re.Match) -> bool:
    try:
        head, body = (json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4))) for part in m.groups())
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str)


RULES = {"assign": (ASSIGN, lambda m: len(m[2]) >= ASSIGN_MIN), "access": (ACCESS, lambda m: len(m[0]) >= ACCESS_MIN),
         "github": (GITHUB, checksum_ok), "npm": (NPM, checksum_ok),
         "xprv": (XPRV, base58check_ok), "bech32": (BECH32, bech32_ok), "jwt": (JWT, jwt_ok)}


@functools.cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


class PemEnds:
    """End lines of a text by label, and the bytes that no key block holds; each found once."""

    def __init__(self, text: bytes) -> None:
        self.ends: dict[bytes, list[int]] = {}
        for m in PEM_END.finditer(text):
            self.ends.setdefault(m[1], []).append(m.start())
        self.foreign = [m.start() for m in NOT_IN_PEM.finditer(text)] if self.ends else []

    def of(self, begin: re.Match) -> int | None:
        """End of the block that begins with the match: at the first end line of its label, if only
        bytes of a key block stand before it."""
        ends = self.ends.get(begin[1], ())
        i = bisect.bisect_left(ends, begin.end())
        if i == len(ends):
            return None
        j = bisect.bisect_left(self.foreign, begin.end())
        return None if j < len(self.foreign) and self.foreign[j] < ends[i] else ends[i] + len(b"-----END -----") + len(begin[1])


def scan(text: bytes) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in bytes."""
    found, last = [], dict.fromkeys(KINDS, 0)
    # latin-1 gives one character for each byte, so places are byte places
    hits = sorted((end - size + 1, kind) for end, (size, kind) in automaton().iter(text.lower().decode("latin-1")))
    pem = None
    for at, kind in hits:
        if at >= last[kind] and kind == "pem":
            if m := PEM_BEGIN.match(text, at):
                pem = pem or PemEnds(text)
                if end := pem.of(m):
                    last[kind] = end
                    found.append((at, end, kind))
        elif at >= last[kind]:
            pattern, valid = RULES[kind]
            if m := pattern.match(text, at):
                last[kind] = m.end()  # also if it is not valid: no second try within a match
                if valid(m):
                    found.append((m.start(), m.end(), kind))
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def in_code_points(text: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    if not spans or text.isascii():
        return spans
    places, at, n = {}, 0, 0
    for p in sorted({p for s in spans for p in s[:2]}):
        n += len(text[at:p].decode())
        at, places[p] = p, n
    return [(places[a], places[b], k) for a, b, k in spans]


def report(texts: pa.Array) -> list[list]:
    out: list[list] = [[] for _ in FIELDS]
    for text in C.as_bytes(texts):
        spans = sorted(in_code_points(text, scan(text)), key=lambda s: (s[0], KINDS.index(s[2])))
        base = [s for s in spans if s[2] in BASE_KINDS]
        row = [sum(s[2] == k for s in base) for k in BASE_KINDS]
        joined = [",".join(f"{k}:{a}:{b}" for a, b, k in x) for x in (base, spans)]
        for column, value in zip(out, [*row, hashlib.sha256(joined[0].encode()).hexdigest(), joined[1]]):
            column.append(value)
    return out


def secret_scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the count of each base kind, the digest of the base spans, and all spans."""
    return C.annotate(df, text_col, report, FIELDS)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(C.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

"""Secret scan: keyword prefilter, anchored expressions, checksum validation.

An Aho-Corasick automaton over lower-cased keywords finds where a secret may
start; only there an expression is tried, anchored at the hit. Hex runs have
no keyword and are found by their own expression. Formats with an embedded
checksum or structure are reported only when that is valid:

``github`` and ``npm`` tokens end in the CRC-32 of their random part, in six
base-62 digits; a ``jwt`` has a JSON object with an ``alg`` as its header and a
JSON object as its payload; a ``pem`` private key block, encrypted ones too,
must be closed by the matching line; an extended private key (``xprv``) ends in
four bytes of its double SHA-256; ``age`` and ``nsec`` secret keys carry a
Bech32 checksum.

Time is linear in the text: keyword hits of one kind come in order, a match is
not entered again, and neither is a run of characters in which a token could
not be completed (whichever hit of the run it began at, it would go on alike).
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import string
from collections.abc import Callable, Iterator
from functools import lru_cache
from zlib import crc32

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from civicspark.llm.common import LOWER, UPPER, byte_slices

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem", "xprv", "age", "nsec")
BASE_KINDS = KINDS[:3]

SLICE_BYTES = 8 << 20

# The patterns of the base kinds and the shortest matches kept.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_MIN_ASSIGN, _MIN_ACCESS, _MIN_HEX = 6, 20, 24

_GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]*+")
# Lines of headers ("Proc-Type: 4,ENCRYPTED") may come before the key; nothing within holds five hyphens.
_PEM = re.compile(r"-----BEGIN ([A-Z ]*+(?<=PRIVATE KEY))-----\s*+(?:[A-Za-z0-9-]++:(?:(?!-----)[^\n])*+\n\s*+)*+[A-Za-z0-9+/=\s]++-----END \1-----")
_XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
_AGE = re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![A-Z0-9])")
_NSEC = re.compile(r"nsec1[02-9ac-hj-np-z]{58}(?![a-z0-9])")

_BASE62 = string.digits + UPPER + LOWER
_LOWER_TABLE = str.maketrans(UPPER, LOWER)


def base62_checksum(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits, the highest first."""
    n, digits = crc32(body.encode("ascii")), []
    for _ in range(6):
        n, d = divmod(n, 62)
        digits.append(_BASE62[d])
    return "".join(reversed(digits))


def _checked(match: re.Match) -> bool:
    body = match.group().partition("_")[2]
    return base62_checksum(body[:-6]) == body[-6:]


def _json_part(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return None


def _jwt_valid(match: re.Match) -> bool:
    header, payload, _ = match.group().split(".")
    head = _json_part(header)
    return isinstance(head, dict) and "alg" in head and isinstance(_json_part(payload), dict)


# The alphabets of Base58 and Bech32 and the generator of the latter's checksum.
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def base58_valid(match: re.Match) -> bool:
    """Whether the last four bytes are those of the double SHA-256 of the others."""
    n = 0
    for c in match.group():
        n = 58 * n + _BASE58.index(c)
    raw = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_valid(match: re.Match) -> bool:
    """Whether prefix and data digits leave the checksum's remainder 1."""
    prefix, _, data = match.group().lower().rpartition("1")
    digits = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [_BECH32.index(c) for c in data]
    rest = 1
    for d in digits:
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ d
        for i, g in enumerate(_BECH32_GENERATOR):
            rest ^= g if top >> i & 1 else 0
    return rest == 1


#: Keyword (lower case) -> kind, expression and validation. A kind's matches never overlap each other.
_RULES: dict[str, tuple[str, re.Pattern, Callable[[re.Match], bool]]] = {
    **{k: ("assign", _ASSIGN, lambda m: len(m.group(2)) >= _MIN_ASSIGN) for k in ("password", "passwd", "secret", "token", "apikey", "api_key")},
    "akia": ("access", _ACCESS, lambda m: len(m.group()) >= _MIN_ACCESS),
    **{k: ("github", _GITHUB, _checked) for k in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")},
    "npm_": ("npm", _NPM, _checked),
    "eyj": ("jwt", _JWT, _jwt_valid),
    "-----begin ": ("pem", _PEM, lambda m: True),
    "xprv": ("xprv", _XPRV, base58_valid),
    "age-secret-key-1": ("age", _AGE, bech32_valid),
    "nsec1": ("nsec", _NSEC, bech32_valid),
}
#: Kinds whose matches begin with a run of characters: without a match at one hit there is none at another of its run.
_RUNS = {"jwt": _JWT_RUN}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for keyword, (kind, pattern, valid) in _RULES.items():
        automaton.add_word(keyword, (len(keyword), kind, pattern, valid))
    automaton.make_automaton()
    return automaton


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of every secret, by start, then kind; code points, end exclusive."""
    low = text.lower()
    if len(low) != len(text):  # some capitals lower to two characters
        low = text.translate(_LOWER_TABLE)
    spans, taken = [], dict.fromkeys(KINDS, 0)
    # Hits come by end; within one kind starts ascend too, as no keyword of a kind holds another.
    for last, (length, kind, pattern, valid) in _automaton().iter(low):
        start = last - length + 1
        if start < taken[kind]:
            continue
        match = pattern.match(text, start)
        if match:
            taken[kind] = match.end()
            if valid(match):
                spans.append((kind, start, match.end()))
        elif kind in _RUNS:
            taken[kind] = _RUNS[kind].match(text, start).end()
    for match in _HEX_LONG.finditer(text):
        spans.append(("hex", match.start(), match.end()))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[1], order[s[0]]))


#: A greedy run of 24 or more is exactly a maximal run that is long enough.
_HEX_LONG = re.compile(_HEX.pattern[:-1] + "{%d,}" % _MIN_HEX)

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def scan_secrets(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` plus ``spans``: an array of ``(kind, start, end)`` over each whole text.

    A null or empty text has none; repeated rows have theirs each; the time
    for a very long text is in proportion to it. A column already named
    ``spans_col`` is replaced, all others stay as they are. An empty table
    gives an empty result. One Arrow pass, no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name != spans_col]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([*kept, T.StructField(spans_col, T.ArrayType(span, False), False)])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text_col, SLICE_BYTES):
                column = part.column(part.schema.get_field_index(text_col))
                found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_secrets(t.as_py())] if t.is_valid else [] for t in column]
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.list_(_SPAN))], names=[*names, spans_col])

    return docs.select(*(f"`{n}`" for n in names)).mapInArrow(run, schema)

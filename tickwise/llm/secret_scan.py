"""Secret scan: a keyword automaton finds places, anchored patterns look only
there, and tokens that carry a checksum must have the right one.

``scan`` is the operator; ``op7_secrets`` derives the digest columns.

Edge cases: a null text counts as empty and has no spans; repeated rows each
give a row; an empty table gives an empty result; columns of the input beside
``key`` and ``text`` are ignored.  Spans count in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import table

#: The patterns, least lengths and order of kinds to report.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "checked")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
    "akia": "access",
    "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked",
}
#: A prefix, 30 random characters, and the CRC-32 of those in six base-62 digits.
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = "{key} long, spans array<struct<kind: string, start: long, end: long>>"


def base62_crc(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = DIGITS[d] + out
    return out


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


def spans_of(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every secret, in order of start, then kind.

    A pattern of a kind can only begin at a keyword of that kind, so matching
    anchored at the hits in order, past the end of the last match, gives the
    leftmost non-overlapping matches.  Hexadecimal runs have no keyword."""
    found, free = [], dict.fromkeys(KINDS, 0)
    folded = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only: positions stay
    for last, (kind, size) in automaton().iter(folded):
        at = last - size + 1
        if at < free[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, at):
                free[kind] = m.end()
                if len(m[2]) >= 6:
                    found.append((at, kind, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, at):
                free[kind] = m.end()
                if m.end() - at >= 20:
                    found.append((at, kind, m.end()))
        elif (m := CHECKED.match(text, at)) and base62_crc(m[1]) == m[2]:
            free[kind] = m.end()
            found.append((at, kind, m.end()))
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key and the spans of its whole text."""

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for s, k, e in spans_of(t or "")] for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], [key, "spans"])

    return docs.select(docs[key].cast("long").alias(key), text).mapInArrow(run, SCHEMA.format(key=key))


def digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, the digest of the base spans and all spans as text."""

    def run(batches):
        for b in batches:
            rows = [[(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in x.as_py()] for x in b.column(1)]
            counts = [pa.array([sum(k == kind for k, _ in r) for r in rows], pa.int64()) for kind in KINDS[:3]]
            base = [hashlib.sha256(",".join(t for k, t in r if k in KINDS[:3]).encode()).hexdigest() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array(base, pa.string()), pa.array([",".join(t for _, t in r) for r in rows], pa.string())],
                [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scanned.mapInArrow(run, f"{key} long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op7_secrets(spark, sf_dir):
    return digests(scan(table(spark, sf_dir, "documents", "doc_id", "text")))

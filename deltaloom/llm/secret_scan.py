"""Secrets in texts: a keyword automaton finds where one may begin, patterns anchored there decide, checksums confirm.

A text is searched as bytes, in windows that overlap by the longest keyword, so a text of any length costs one window
beside itself. Two Aho-Corasick automata run over a window: one over its letters in lower case, for keywords; one over
its bytes' classes, for as many hexadecimal digits in a row as the least match has. No pattern is tried anywhere else.
A kind's hits are taken from left to right; those inside a match of the kind are passed over, which gives what a search
from left to right for the pattern alone would give.

Kinds of BASE are told by their form. Kinds of CHECKED carry a checksum of their own characters, and only those whose
checksum is right are found: access tokens whose last six characters are the CRC-32 of the thirty before in base 62.

Defined results: null and empty texts have no spans (an empty string, its digest for base_sha256); bytes that are not
UTF-8 count as one character for each byte that doesn't continue one; rows that repeat are scanned each, rows without an
id too; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, ship, table

WINDOW = 4 << 20
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HEX = b"0123456789abcdef"
#: Bytes by class: h for a hexadecimal digit, a space for others.
CLASSES = bytes(104 if c in HEX else 32 for c in range(256))
LEAST_HEX = 32
#: Digits of the checksums, fixed by the tokens' format.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Kind:
    """pattern is matched where one of the keywords (in lower case) begins; good tells which matches are kept."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    good: Callable[[re.Match], bool]


def base62_crc(body: bytes) -> bytes:
    """The CRC-32 of body as six digits of base 62."""
    n, digits = zlib.crc32(body), []
    for _ in range(6):
        n, rest = divmod(n, 62)
        digits.append(BASE62[rest])
    return "".join(reversed(digits)).encode()


def checked(match: re.Match) -> bool:
    body = match[1]
    return len(body) == 36 and base62_crc(body[:30]) == body[30:]


BASE = (
    Kind(
        "assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), lambda m: len(m[2]) >= 8,
    ),
    Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 16),
    Kind("hex", ("h" * LEAST_HEX,), re.compile(rb"[0-9a-f]+"), lambda m: m.end() - m.start() >= LEAST_HEX),
)
CHECKED = (
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(rb"gh[pousr]_([0-9A-Za-z]+)"), checked),
    Kind("npm", ("npm_",), re.compile(rb"npm_([0-9A-Za-z]+)"), checked),
)
KINDS = BASE + CHECKED


@functools.cache
def automata() -> tuple[tuple[ahocorasick.Automaton, bytes], ...]:
    """(automaton, bytes' translation it runs on); an automaton's values are (kind's number, keyword's length)."""
    plain, classes = ahocorasick.Automaton(), ahocorasick.Automaton()
    for n, kind in enumerate(KINDS):
        for word in kind.keywords:
            (classes if kind.name == "hex" else plain).add_word(word, (n, len(word)))
    plain.make_automaton()
    classes.make_automaton()
    return (plain, LOWER), (classes, CLASSES)


def hits(raw: bytes) -> list[list[int]]:
    """For each kind the places where its keywords begin, from left to right."""
    longest = max(len(w) for k in KINDS for w in k.keywords)
    found: list[list[int]] = [[] for _ in KINDS]
    for begin in range(0, len(raw), WINDOW):
        part = raw[begin : begin + WINDOW + longest - 1]
        for automaton, translation in automata():
            for end, (n, size) in automaton.iter(part.translate(translation).decode("latin-1")):
                if end - size + 1 < WINDOW:
                    found[n].append(begin + end - size + 1)
    return [sorted(f) for f in found]


def byte_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind's number), by start and then kind."""
    out = []
    for n, (kind, places) in enumerate(zip(KINDS, hits(raw), strict=True)):
        end = 0
        for at in places:
            if at >= end and (match := kind.pattern.match(raw, at)):
                end = match.end()
                if kind.good(match):
                    out.append((at, end, n))
    return sorted(out, key=lambda s: (s[0], s[2]))


def spans(text: bytes | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text given in UTF-8, in code points, by start and then kind."""
    raw = text or b""
    found = byte_spans(raw)
    if found and not raw.isascii():
        edges = sorted({p for a, b, _ in found for p in (a, b)})
        starts = np.array([0, *edges])
        own = [int(np.count_nonzero((np.frombuffer(raw, np.uint8, b - a, a) & 0xC0) != 0x80)) if b > a else 0 for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        place = dict(zip(edges, np.cumsum(own).tolist(), strict=True))
        found = [(place[a], place[b], n) for a, b, n in found]
    return [(KINDS[n].name, a, b) for a, b, n in found]


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def scanned(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text) with spans, an array of (kind, start, end), in place of the text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = batch["text"].cast(pa.binary())
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans(t.as_py())] for t in texts]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, kind)], ["doc_id", "spans"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def told(found: str) -> str:
    """A SQL expression: spans as kind:start:end, joined by commas."""
    return f"array_join(transform({found}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ", ".join(f"'{k.name}'" for k in BASE)
    counts = [f"cast(size(filter(spans, s -> s.kind = '{k.name}')) as bigint) as n_{k.name}" for k in BASE]
    own = told(f"filter(spans, s -> s.kind in ({base}))")
    return scanned(table(spark, sf_dir, "documents")).selectExpr("doc_id", *counts, f"sha2({own}, 256) as base_sha256", f"{told('spans')} as spans")


__all__ = ["BASE", "CHECKED", "KINDS", "base62_crc", "op13_secrets", "scanned", "spans"]

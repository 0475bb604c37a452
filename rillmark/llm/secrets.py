"""Secret scan with multipart credential linking.

Strong findings (assignments, access keys, long hex runs) are always reported.  Weak candidates
(bare identifiers, mixed tokens, endpoints) alone mean nothing; within a scope of adjoining lines
they are joined as intervals, and reported only where a complementary part stands near.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

# ---- fixed patterns
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
IDENT = re.compile(
    r"\b(?:user(?:name)?|login|client_?id|account|key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]{3,})",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20\"'<>]{3,}")
BLOB = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
# ----

KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")
BASE = KINDS[:3]
# what each kind is a part of a credential as, and what must stand near a weak one
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "ident": "identifier", "blob": "secret", "endpoint": "endpoint"}
COMPLEMENTS = {"ident": ("secret",), "blob": ("identifier", "endpoint"), "endpoint": ("secret", "identifier")}
REACH = 240

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Strong findings: leftmost non-overlapping matches of each kind, short ones dropped afterwards."""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return _ordered(spans)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _weak(text: str, strong: list[Span]) -> list[Span]:
    """Weak candidates that overlap neither a strong finding nor an earlier weak kind."""
    taken = sorted((start, end) for start, end, _ in strong)
    found: list[Span] = []
    for kind, pattern in (("endpoint", ENDPOINT), ("ident", IDENT), ("blob", BLOB)):
        cover, reach = [], 0
        for start, end in taken:
            reach = max(reach, end)
            cover.append(reach)
        starts = [start for start, _ in taken]
        mine = []
        for m in pattern.finditer(text):
            if kind == "blob" and not (re.search("[0-9]", m[0]) and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0])):
                continue
            before = bisect_left(starts, m.end()) - 1
            if before < 0 or cover[before] <= m.start():
                mine.append((*m.span(), kind))
        found += mine
        taken = sorted(taken + [(start, end) for start, end, _ in mine])
    return found


def link(text: str) -> tuple[list[Span], list[Span]]:
    """The strong spans, and all reported spans in order."""
    strong = base_spans(text)
    weak = _weak(text, strong)
    if not weak:
        return strong, strong
    borders = [m.start() for m in SCOPE_END.finditer(text)]
    # starts and ends of the parts by scope and role; parts of one role seldom overlap, and a part's
    # own length is added to the reach, so the two neighbours by start decide
    parts: dict[tuple[int, str], list[tuple[int, int]]] = {}
    for start, end, kind in sorted(strong + weak):
        parts.setdefault((bisect_left(borders, start), ROLE[kind]), []).append((start, end))
    furthest = {}
    for key, spans in parts.items():
        ends, most = [], 0
        for _, end in spans:
            most = max(most, end)
            ends.append(most)
        furthest[key] = ([start for start, _ in spans], ends)
    reported = []
    for start, end, kind in weak:
        scope = bisect_left(borders, start)
        for role in COMPLEMENTS[kind]:
            starts, ends = furthest.get((scope, role), ([], []))
            last = bisect_left(starts, end + REACH) - 1
            if last >= 0 and ends[last] > start - REACH:
                reported.append((start, end, kind))
                break
    return strong, _ordered(strong + reported)


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, counts per strong kind, digest of the strong spans, all spans.

    Offsets are code points, ends exclusive.  A null text is empty; a null id stays null; repeated
    rows give repeated results; an empty table gives no rows.  Other columns are not read, so their
    names cannot clash.  No shuffle: every text is searched whole where it was read.  Weak parts are
    reported if a complement stands in their paragraph, no more than ``REACH`` code points away.
    """
    schema = (
        f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint,"
        " base_sha256 string, spans string"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {kind: [] for kind in BASE}
            digests, spans = [], []
            for value in batch.column(1):
                strong, every = link(value.as_py() or "")
                for kind in BASE:
                    counts[kind].append(sum(s[2] == kind for s in strong))
                digests.append(sha256(as_text(strong).encode()).hexdigest())
                spans.append(as_text(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=[doc_id, "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select(doc_id, text).mapInArrow(search, schema)

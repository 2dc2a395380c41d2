"""Secret scans: patterns, and Shannon entropy of sliding windows over candidate strings.

A candidate is a run of ``CANDIDATE`` characters. For each class (lower or upper hex, alnum, base64)
it is cut into the longest runs of that class; those with a letter and a digit count. A window slides
over each; the counts of its characters change by one in and one out per step, and with them the sum
of c * log2(c) that gives the entropy. Windows above the class's limit join into spans; a span inside
one of another class is left out, of equal ones the narrower class stays. No window
touches what the allow-list knows: mail addresses, host and path of web addresses (their user names
and queries are scanned), UUIDs, well-known digests, and placeholders with the letters and digits
joined to them, up to ``REACH`` on either side. Nor does a span count inside a pattern's match;
pattern matches always stay.

Null or empty text: no spans. A text is swept once, so a long one takes time in proportion to its length
and its number of spans. Ties: spans at one place are listed by kind. An empty table gives no rows. Rows are scanned each by itself, so repeated rows and null doc_ids
give their own results; extra columns pass through ``redact`` and stay out of ``scan``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from shoplens.llm.words import slices

#: The patterns every scan reports, in this order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

#: Window in characters, and per class its characters and the entropy in bits that counts as random.
WINDOW = 20
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9a-f]{%d,}" % WINDOW), 3.0),
    ("entropy_hex", re.compile(r"[0-9A-F]{%d,}" % WINDOW), 3.0),
    ("entropy_alnum", re.compile(r"[A-Za-z0-9]{%d,}" % WINDOW), 3.7),
    ("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW), 3.8),
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
#: What looks random and is not secret.
ALLOWED = (
    re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9A-Za-z])",
               re.IGNORECASE | re.ASCII),
    re.compile(r"(?<![0-9A-Za-z])(d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709)"
               r"(?![0-9A-Za-z])"),
)
REACH = WINDOW // 2
SLICE = 1 << 20  # bytes of text scanned at a time, one text at least
PLACEHOLDER = re.compile(
    r"[A-Za-z0-9]{0,%d}?"
    r"(example|sample|dummy|placeholder|changeme|your[_-]?|xxxx|0123456789|abcdefgh)"
    r"(?:(?<![_-])[A-Za-z0-9]{0,%d})?" % (REACH, REACH),
    re.IGNORECASE | re.ASCII,
)
#: Group 1 is what stands before the host, group 2 host and path.
WEB = re.compile(r"(?:https?|ftp)://([^\s/?#@\"'<>]*@)?([^\s?#\"'<>]*)", re.IGNORECASE)
MAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]+")
BITS = [0.0, 0.0, *(c * math.log2(c) for c in range(2, WINDOW + 1))]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return spans


def random_runs(string: str, limit: float) -> list[tuple[int, int]]:
    """Where windows of entropy ``limit`` or more lie, neighbouring windows joined."""
    counts: dict[str, int] = {}
    total, runs, most = 0.0, [], math.log2(WINDOW)
    for end, new in enumerate(string, 1):
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += BITS[c + 1] - BITS[c]
        if end < WINDOW:
            continue
        if most - total / WINDOW >= limit:
            start = end - WINDOW
            if runs and runs[-1][1] >= start:
                runs[-1] = (runs[-1][0], end)
            else:
                runs.append((start, end))
        old = string[end - WINDOW]
        c = counts[old]
        counts[old] = c - 1
        total += BITS[c - 1] - BITS[c]
    return runs


def addresses_in(text: str) -> list[tuple[int, int]]:
    """Host and path of web addresses, and mail addresses outside of web addresses' user names."""
    found, users = [], set()
    if "://" in text:
        for m in WEB.finditer(text):
            found.append(m.span(2))
            users.add(m.end(1))
    if "@" in text:
        for m in MAIL.finditer(text):
            if text.index("@", m.start()) + 1 not in users:
                found.append(m.span())
    return sorted(found)


def mixed(string: str) -> bool:
    return any(map(str.isdigit, string)) and any(map(str.isalpha, string))


def without_nested(found: list[tuple], more: list[tuple]) -> list[tuple]:
    """Both lists of spans as one, none inside another; of equal ones that of ``found`` stays. Each is
    sorted and has no nested spans, so its ends ascend like its starts."""
    starts = [span[0] for span in found]
    dropped, added = set(), []
    for span in more:
        before = bisect_right(starts, span[0]) - 1
        if before >= 0 and found[before][1] >= span[1]:
            continue
        added.append(span)
        at = bisect_left(starts, span[0])
        while at < len(found) and found[at][1] <= span[1]:
            dropped.add(at)
            at += 1
    return sorted([s for i, s in enumerate(found) if i not in dropped] + added)


def class_spans(string: str) -> list[tuple[int, int, str]]:
    """The spans of all classes in a candidate; none inside another."""
    found: list[tuple[int, int, str]] = []
    for kind, pattern, limit in CLASSES:
        found = without_nested(found, [
            (m.start() + a, m.start() + b, kind)
            for m in pattern.finditer(string) if mixed(m[0]) for a, b in random_runs(m[0], limit)
        ])
    return found


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    spans: list[tuple[int, int, str]] = []
    candidates = [m.span() for m in CANDIDATE.finditer(text) if mixed(m[0])]
    addresses, first = addresses_in(text) if candidates else [], 0
    for start, end in candidates:
        known = [m.span() for p in (*ALLOWED, PLACEHOLDER) for m in p.finditer(text, start, end)]
        while first < len(addresses) and addresses[first][1] <= start:
            first += 1
        for place in range(first, len(addresses)):
            a, b = addresses[place]
            if a >= end:
                break
            if b > start:
                known.append((max(a, start), min(b, end)))
        at = start
        for a, b in [*sorted(known), (end, end)]:
            if a - at >= WINDOW:
                spans += [(at + x, at + y, kind) for x, y, kind in class_spans(text[at:a])]
            at = max(at, b)
    return spans


def find_secrets(text: str | None) -> tuple[list, list]:
    """(pattern spans, all spans), each (start, end, kind) by start and then by kind."""
    text = text or ""
    by = lambda span: (span[0], ORDER[span[2]], span[1])
    base = sorted(base_spans(text), key=by)
    starts, reach = [b[0] for b in base], list(accumulate((b[1] for b in base), max))
    added = []
    for span in entropy_spans(text):
        before = bisect_right(starts, span[0])
        if not before or reach[before - 1] < span[1]:
            added.append(span)
    return base, sorted(base + added, key=by)


def written(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the number of matches of each pattern, their digest, and all spans as text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in part.column("text").to_pylist():
                base, found = find_secrets(text)
                for kind, column in zip(KINDS, counts):
                    column.append(sum(s[2] == kind for s in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(found))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        find,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        "spans string",
    )


def masked(text: str, spans: list, mark: str) -> str:
    """``text`` with every span, overlapping ones together, replaced by ``mark``."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, with every secret in ``text`` replaced; a null text stays null."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            texts = part.column("text").to_pylist()
            for i, text in enumerate(texts):
                if text and (spans := find_secrets(text)[1]):
                    texts[i] = masked(text, spans, mark)
            place = part.schema.get_field_index("text")
            yield part.set_column(place, part.schema.field(place), pa.array(texts, pa.string()))

    return docs.mapInArrow(clean, docs.schema)

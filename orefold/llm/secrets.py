"""Secret scans: base patterns, and credentials whose parts are linked within a scope.

Base kinds are leftmost, non-overlapping matches:

* ``assign``: a keyword, ``:`` or ``=``, and a value of 8 or more characters,
* ``access``: an access key id, ``hex``: 32 or more lower-case hex digits.

The method adds credentials that come in parts. Parts are intervals of three roles:

* identifier: access key ids, ``user``/``login``/``client_id`` assignments, e-mail names,
* secret: base assignments and hex runs, and weak candidates: a free-standing run of 16 or
  more characters that mixes letters and digits, also after ``=`` or ``:``; an assignment to
  a name that is or ends in ``pass``, ``pwd``, ``key`` or a keyword, of 4 characters or more,
  which is no base match,
* endpoint: URLs with a scheme, ``host:port``, ``host``/``server``/``endpoint`` assignments.

Names of assignments may have a prefix (``DB_USER``, ``db-pass``, ``accessKey``); the span
begins at the word itself. ``scheme://user:secret@host`` is three parts that belong together.

Each text is cut into scopes at blank lines, and the parts are joined to scopes by their
intervals, whatever lies between them. A scope is complete if it has an access key id, or an
identifier and an endpoint. A complete scope reports all its weak candidates (``weak``), and,
if it has any secret, base or weak, all its identifiers and endpoints (``ident``,
``endpoint``); other scopes report none of these. Base spans are reported in any case. The
join is a merge of sorted positions, so no pairs are formed; it needs only the text itself and
no shuffle. Searches start from ``@``, ``:`` or a keyword, so that their time is linear in the
text.

Defined results: a null text is empty and has no spans; repeated rows are scanned one by
one; overlapping spans of different kinds are all reported; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import over_slices

# fixed values: the base patterns, their order, and least lengths
ASSIGN = re.compile(
    rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "weak", "ident", "endpoint")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

WEAK_ASSIGN = re.compile(
    rb"""(?:(?<![A-Za-z0-9])(?i:pass|password|passwd|pwd|key|secret|token)|(?<=[a-z0-9])(?:Pass|Password|Pwd|Key|Secret|Token))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{4,})"""
)
WEAK_RUN = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
IDENT = re.compile(
    rb"""(?i)(?<![A-Za-z0-9])(?:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{2,}"""
)
# what follows an anchor; what comes before it is found by going back over ``_run_before``
MAIL_HOST = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
HOST = re.compile(
    rb"""(?i)(?<![A-Za-z0-9])(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[a-z0-9.-]{3,}(?::\d+)?"""
)
URL_REST = re.compile(rb"""://[^\s"'<>]+""")
PORT = re.compile(rb":\d{2,5}\b")
_MAIL_NAME = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_HOST_NAME = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.-")
LOGIN = re.compile(rb"""://([^\s"'<>/@:]*):([^\s"'<>/@]+)@([^\s"'<>/?#,@]+)""")
BLANK_LINE = re.compile(rb"\n[\x20\t\r]*\n")
_HEX_MARK = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_linked long, "
    "base_spans string, spans string"
)


def base_spans(text: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes. Cheap searches decide if a pattern is worth running."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_VALUE
        ]
    if b"AKIA" in text:
        out += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    if b"\1" * HEX_LENGTH in text.translate(_HEX_MARK):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def _run_before(text: bytes, end: int, least: int, inside: frozenset) -> int:
    """Where the run of bytes of ``inside`` that ends at ``end`` begins, not before ``least``."""
    while end > least and text[end - 1] in inside:
        end -= 1
    return end


def mails(text: bytes) -> Iterator[tuple[int, int]]:
    """``name@host.domain``, left to right, without overlaps."""
    done, at = 0, text.find(b"@")
    while at >= 0:
        start = _run_before(text, at, done, _MAIL_NAME)
        host = MAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            yield start, done
        at = text.find(b"@", at + 1)


def urls(text: bytes) -> Iterator[tuple[int, int]]:
    """``scheme://...``, without overlaps; a scheme begins with a letter."""
    done, at = 0, text.find(b"://")
    while at >= 0:
        start = _run_before(text, at, done, _SCHEME)
        while start < at and not text[start : start + 1].isalpha():
            start += 1
        rest = URL_REST.match(text, at) if start < at else None
        if rest:
            done = rest.end()
            yield start, done
        at = text.find(b"://", max(done, at + 1))


def hosts_with_port(text: bytes) -> Iterator[tuple[int, int]]:
    """``name.domain:port``: labels of letters, digits and hyphens."""
    done = 0
    for m in PORT.finditer(text):
        run = _run_before(text, m.start(), done, _HOST_NAME)
        name = text[run : m.start()]
        # empty labels end a name; it begins with a letter or digit
        start = run + name.rfind(b"..") + 2 if b".." in name else run
        while start < m.start() and not text[start : start + 1].isalnum():
            start += 1
        if b"." in text[start : m.start()] and text[m.start() - 1 : m.start()] != b".":
            done = m.end()
            yield start, done


def parts_of(text: bytes, base: list[tuple[int, int, str]]) -> dict[str, list[tuple[int, int]]]:
    """Sorted spans of the parts: ``access``, ``strong`` (base secrets), ``weak``, ``ident``,
    ``endpoint``. Where parts overlap, logins in URLs come before all others, base secrets
    before identifiers and weak candidates, endpoints and identifiers before weak ones, and
    assignments before runs."""
    logins = list(LOGIN.finditer(text)) if b"://" in text else []
    within = Spans((m.start(), m.end()) for m in logins)
    strong = Spans((s, e) for s, e, kind in base if kind != "access")
    idents = [m.span() for m in IDENT.finditer(text)] + list(mails(text))
    idents = [i for i in idents if not within.overlap(i)] + [m.span(1) for m in logins if m[1]]
    points = [m.span() for m in HOST.finditer(text)] + list(urls(text)) + list(hosts_with_port(text))
    points = [p for p in points if not within.overlap(p)] + [m.span(3) for m in logins]
    base_parts, taken = Spans((s, e) for s, e, _ in base), Spans(points + idents)
    weak = {m.span() for m in WEAK_ASSIGN.finditer(text)}
    weak = {w for w in weak if not within.overlap(w)} | {m.span(2) for m in logins}
    settled = Spans(weak)
    runs = {m.span() for m in WEAK_RUN.finditer(text) if _mixed(m[0])}
    weak |= {r for r in runs if not settled.overlap(r)}
    return {
        "access": sorted((s, e) for s, e, kind in base if kind == "access"),
        "strong": strong.spans,
        "weak": sorted(w for w in weak if not base_parts.overlap(w) and not taken.overlap(w)),
        # an e-mail name or an assignment that reads into a base secret is no part of its own
        "ident": sorted({i for i in idents if not strong.overlap(i)}),
        "endpoint": sorted(set(points)),
    }


def linked_spans(text: bytes, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak candidates of complete scopes, and the parts that complete them."""
    if not base and b"=" not in text and b":" not in text:
        return []  # no identifier beside an endpoint can be there
    parts = parts_of(text, base)
    if not parts["access"] and not (parts["ident"] and parts["endpoint"]):
        return []
    breaks = [m.start() for m in BLANK_LINE.finditer(text)]
    scopes: dict[int, dict[str, list]] = {}
    for role, spans in parts.items():
        for span in spans:
            scopes.setdefault(bisect.bisect_right(breaks, span[0]), {}).setdefault(role, []).append(span)
    out = []
    for held in scopes.values():
        complete = "access" in held or ("ident" in held and "endpoint" in held)
        if complete and ("weak" in held or "strong" in held):
            out += [(*span, role) for role in ("weak", "ident", "endpoint") for span in held.get(role, ())]
    return sorted(out)


def _mixed(run: bytes) -> bool:
    return (
        any(48 <= b < 58 for b in run) and any(65 <= b < 91 or 97 <= b < 123 for b in run)
    )


class Spans:
    """Spans sorted by start, with the greatest end so far."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.spans = sorted(spans)
        # up to each span, the number of the one that ends last
        self.widest = list(
            itertools.accumulate(range(len(self.spans)), lambda i, j: j if self.spans[j][1] >= self.spans[i][1] else i)
        )

    def overlap(self, one: tuple[int, int]) -> bool:
        k = bisect.bisect_left(self.spans, (one[1],))
        return k > 0 and self.spans[self.widest[k - 1]][1] > one[0]


def render(spans: list[tuple[int, int, str]], text: bytes) -> str:
    """``kind:start:end`` in code points, by start, then kind as listed, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    if text.isascii():
        return ",".join(f"{kind}:{s}:{e}" for s, e, kind in ordered)
    out, seen, points = [], 0, 0
    for s, e, kind in ordered:
        points += _points(text[seen:s])
        seen = s
        out.append(f"{kind}:{points}:{points + _points(text[s:e])}")
    return ",".join(out)


def _points(part: bytes) -> int:
    return len(part) - sum(1 for b in part if b & 0xC0 == 0x80) if len(part) < 64 else len(
        part.decode("utf-8", "surrogatepass")
    )


def secrets_in(docs: DataFrame) -> DataFrame:
    """Counts and spans of secrets for each document."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        counts, base_out, all_out = [[], [], [], []], [], []
        for text in texts.to_pylist():
            base = base_spans(text)
            more = linked_spans(text, base)
            for c, kind in zip(counts, KINDS):
                c.append(sum(1 for s in base + more if s[2] == kind))
            base_out.append(render(base, text) if base else "")
            all_out.append(render([*base, *more], text) if more else base_out[-1])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id")] + [pa.array(c, pa.int64()) for c in counts]
            + [pa.array(base_out, pa.string()), pa.array(all_out, pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_linked", "base_spans", "spans"],
        )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(over_slices(work), SCHEMA)


def digest(scanned: DataFrame) -> DataFrame:
    """The result of the query: counts, the hash of the base spans, and all spans."""
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans", "n_linked",
    )

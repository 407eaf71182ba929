"""Secret scans with multipart credential linking.

Every text is scanned whole for parts of credentials: identifiers, secrets and
endpoints.  Some are findings by themselves (the base kinds: assigned passwords
and tokens, AKIA identifiers, long hex runs).  Weak candidates are reported only
when parts of the complementary kinds lie within one scope, SCOPE code points on
either side: an interval join, per text, of the candidates with the scopes of all
other parts, both ways.

- ``secret``, a bare run of 40 base64 characters (or 86 and ``==``): beside an AKIA
  identifier, or beside an assigned identifier and an endpoint.
- ``identifier``, an assigned client, user, account, tenant or key id: beside an
  assigned secret, or beside a bare secret and an endpoint.
- ``endpoint``, an address with a scheme: beside an assigned secret, or beside any
  identifier and any secret.

A bare secret or identifier that overlaps a base span, or a bare secret that overlaps
an identifier, is no part of its own.

Null and empty texts have no spans.  Very long texts are scanned whole, in time
linear in their length but for sorting the parts found.  Spans are code points, end
exclusive; of parts that start together, kinds go in their listed order.  Equal rows
have equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_of, utf8

# The base kinds, in the order in which they are listed.
BASE = ("assign", "access", "hex")
#: Kinds that linking adds, listed after the base kinds.
LINKED = ("secret", "identifier", "endpoint")
KINDS = BASE + LINKED
ASSIGN_, ACCESS_, HEX_, SECRET_, IDENTIFIER_, ENDPOINT_ = range(6)
# The patterns run over UTF-8 bytes with A-Z lower-cased where case does not count.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
#: Weak candidates.
SECRET = re.compile(rb"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{40}|[A-Za-z0-9+/]{86}==)(?![A-Za-z0-9+/=])")
IDENTIFIER = re.compile(rb"""(?<![a-z0-9_-])(?:client_?id|app_?id|user(?:_?name)?|login|account(?:_?id)?|tenant(?:_?id)?|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?[a-z0-9._@+-]{3,}""")
NAMES = (b"client", b"app", b"user", b"login", b"account", b"tenant", b"key")
ENDPOINT = re.compile(rb"(?:https?|s3|gs|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[A-Za-z0-9._:@/-]+")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
#: Code points on either side of a part that are its scope.
SCOPE = 400

Span = tuple[int, int, int]


def base_spans(text: bytes, low: bytes) -> list[Span]:
    """(start, end, kind) in bytes."""
    out = []
    if any(w in low for w in WORDS):
        out += [(m.start(), m.end(), ASSIGN_) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if b"AKIA" in text:
        out += [(m.start(), m.end(), ACCESS_) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), m.end(), HEX_) for m in HEX.finditer(text)]
    return sorted(out)


class Reach:
    """Spans, to be met by others within a distance."""

    def __init__(self, spans):
        spans = sorted(spans)
        self.starts = [s[0] for s in spans]
        self.ends = list(accumulate((s[1] for s in spans), max))

    def near(self, span, scope: int) -> bool:
        """Whether at most `scope` lies between the span and one of these."""
        i = bisect_right(self.starts, span[1] + scope)  # those that begin early enough
        return i > 0 and self.ends[i - 1] + scope >= span[0]

    def overlaps(self, span) -> bool:
        i = bisect_right(self.starts, span[1] - 1)
        return i > 0 and self.ends[i - 1] > span[0]


def weak_spans(text: bytes, low: bytes, base: list[Span]) -> list[Span]:
    """Candidates in bytes; none where no rule could report any."""
    hosts = [(*m.span(), ENDPOINT_) for m in ENDPOINT.finditer(text)] if b"://" in text else []
    access = any(k == ACCESS_ for _, _, k in base)
    if not (access or hosts or any(k == ASSIGN_ for _, _, k in base)):
        return []
    taken = Reach(base)
    named = [(*m.span(), IDENTIFIER_) for m in IDENTIFIER.finditer(low)] if any(n in low for n in NAMES) else []
    named = [s for s in named if not taken.overlaps(s)]
    bare = []
    if access or (named and hosts):
        taken = Reach(base + named)
        bare = [(*m.span(), SECRET_) for m in SECRET.finditer(text)]
        bare = [s for s in bare if not taken.overlaps(s)]
    return bare + named + hosts


def linked(base: list[Span], weak: list[Span], scope: int = SCOPE) -> list[Span]:
    """The weak candidates that complementary parts within their scope support."""
    parts: dict[int, list[Span]] = {k: [] for k in range(len(KINDS))}
    for s in base + weak:
        parts[s[2]].append(s)
    reach = {k: Reach(v) for k, v in parts.items()}
    beside = lambda s, *kinds: any(reach[k].near(s, scope) for k in kinds)
    rules = {
        SECRET_: lambda s: beside(s, ACCESS_) or (beside(s, IDENTIFIER_) and beside(s, ENDPOINT_)),
        IDENTIFIER_: lambda s: beside(s, ASSIGN_) or (beside(s, SECRET_) and beside(s, ENDPOINT_)),
        ENDPOINT_: lambda s: beside(s, ASSIGN_) or (beside(s, ACCESS_, IDENTIFIER_) and beside(s, SECRET_, HEX_)),
    }
    return [s for s in weak if rules[s[2]](s)]


def _points(text: bytes, spans: list[Span]) -> list[Span]:
    """Byte spans as code point spans, in one walk over the text."""
    if not spans or text.isascii():
        return spans
    edges = sorted({x for a, b, _ in spans for x in (a, b)})
    at, n, place = 0, 0, {}
    for e in edges:
        n += len(text[at:e].decode("utf-8", "replace"))
        at, place[e] = e, n
    return [(place[a], place[b], k) for a, b, k in spans]


def scan(text: bytes) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, as code points, by start and then kind."""
    low = text.lower()
    base = base_spans(text, low)
    weak = weak_spans(text, low, base)
    points = _points(text, base + weak)
    base, weak = points[: len(base)], points[len(base) :]
    order = lambda x: (x[0], x[2])
    return sorted(base, key=order), sorted(base + linked(base, weak), key=order)


def render(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id_col, base and spans, arrays of (kind, start, end)."""
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def task(batches):
        for batch in slices(batches):
            found = [scan(x) for x in utf8(batch.column("text"))]
            named = [[[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in part] for part in pair] for pair in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x[0] for x in named], span), pa.array([x[1] for x in named], span)], ["id", "base", "spans"])

    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    return slim.mapInArrow(task, T.StructType([slim.schema["id"], T.StructField("base", kind), T.StructField("spans", kind)])).withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts and digests of find_secrets' spans."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col(id_col).alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))

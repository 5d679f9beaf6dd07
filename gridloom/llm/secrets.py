"""Secret scan with multipart credential linking.

Each whole text is scanned for three strong patterns, which are always reported, and for weak parts: account
identifiers, bare keys and endpoints, each of which means little alone. Parts of a document are
joined by intervals: a weak part is reported only if a part that completes it begins or ends within
``scope`` code points of it. An access identifier is completed by a key, a key by an access identifier or
an endpoint, an account by a key and an endpoint by a key. The interval join is a sorted sweep inside
the document, since a scope never leaves it; nothing is shuffled and no pairs are made.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import DOCUMENT_COLUMNS, bounded, text_of

# The strong patterns, in the order in which kinds sort at one start.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
#: Without one of these (in lower case) a pattern has no match; plain searches cost far less than the patterns.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Weak parts: kind, strings of which a match holds one, pattern, and what they are in a credential.
WEAK = (
    ("key", (), re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"), "secret"),
    ("account", ("user", "login", "client_id", "account"), re.compile(r"(?:user(?:name)?|login|client_id|account)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]{3,})", re.I | re.A), "identity"),
    ("endpoint", ("://",), re.compile(r"(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+", re.A), "place"),
)
ROLES = {"assign": "secret", "access": "identity", "hex": "secret"} | {kind: role for kind, _, _, role in WEAK}
COMPLETED_BY = {"identity": ("secret",), "secret": ("identity", "place"), "place": ("secret",)}
KINDS = ("assign", "access", "hex", "key", "account", "endpoint")

#: Code points between two parts of one credential at most.
SCOPE = 400

Span = tuple[int, int, str]


def strong_spans(text: str) -> list[Span]:
    spans, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    # Runs that are too short to count hold no match that would count: a run is as long as it can be.
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def weak_parts(text: str) -> list[Span]:
    low = text.lower()
    held = ((kind, pattern) for kind, words, pattern, _ in WEAK if not words or any(w in low for w in words))
    return [(m.start(), m.end(), kind) for kind, pattern in held for m in pattern.finditer(text)]


def linked(strong: list[Span], weak: list[Span], scope: int) -> list[Span]:
    """The weak parts that some part completes within ``scope``, by an interval join over sorted starts.

    Two parts meet if their intervals, widened by ``scope``, overlap; parts that overlap each other outright are one
    and the same string, and do not complete each other.
    """
    import numpy as np

    by_role: dict[str, list[Span]] = {}
    for span in (*strong, *weak):
        by_role.setdefault(ROLES[span[2]], []).append(span)
    starts = {role: np.array(sorted(s for s, _, _ in spans)) for role, spans in by_role.items()}
    ends = {role: np.array(sorted(e for _, e, _ in spans)) for role, spans in by_role.items()}

    def completed(span: Span) -> bool:
        start, end, kind = span
        for role in COMPLETED_BY[ROLES[kind]]:
            if role not in starts:
                continue
            after = np.searchsorted(starts[role], [end, end + scope + 1])
            before = np.searchsorted(ends[role], [start - scope, start + 1])
            if after[1] > after[0] or before[1] > before[0]:
                return True
        return False

    return [span for span in weak if completed(span)]


def find_secrets(text: str, scope: int = SCOPE) -> tuple[list[Span], list[Span]]:
    """The strong spans of a text, and the weak ones that are linked, neither inside a strong one."""
    strong = strong_spans(text)
    weak = weak_parts(text)
    if strong and weak:
        # Of the strong spans that begin no later than a weak one, does the one that reaches furthest hold it?
        order = sorted(strong)
        starts, reach = [s for s, _, _ in order], list(accumulate((e for _, e, _ in order), max))
        inside = lambda w: (k := bisect_right(starts, w[0])) and reach[k - 1] >= w[1]
        weak = [w for w in weak if not inside(w)]
    return strong, linked(strong, weak, scope) if weak else []


def shown(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Secrets of every whole text: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    ``spans`` lists ``kind:start:end`` of all spans in code points, end exclusive, by start; base_sha256 is of
    the strong ones alone. Null text counts as empty: no spans, and the hash of the empty string. Repeated
    rows and null ids are scanned like any other; an empty table gives an empty table; other columns
    are not looked at.
    """
    import pyarrow as pa

    def found(batches):
        import hashlib

        for batch in bounded(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                strong, weak = find_secrets(text, scope)
                counts = [sum(k == kind for _, _, k in strong) for kind in ("assign", "access", "hex")]
                rows.append((*counts, hashlib.sha256(shown(strong).encode()).hexdigest(), shown(strong + weak), len(weak)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"
    return rows.mapInArrow(found, schema)


def secret_spans(text: str, scope: int = SCOPE) -> list[Span]:
    """What must not be handed on: strong spans and linked keys, by start."""
    strong, weak = find_secrets(text, scope)
    return sorted([*strong, *(w for w in weak if ROLES[w[2]] == "secret")])


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (the columns of documents) with every secret replaced by ``mark`` and n_chars counted anew.

    Secrets are the strong spans and the bare keys that are linked; the accounts and endpoints that they are linked to stay.
    Overlapping spans are replaced together. Rows without a secret, null texts among them, come back as they were.
    """
    import pyarrow as pa

    columns = [F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in DOCUMENT_COLUMNS]

    def cleaned(batches):
        for batch in bounded(batches):
            texts, sizes = batch.column(1).to_pylist(), batch.column(4).to_pylist()
            for i, text in enumerate(texts):
                if not text or not (spans := secret_spans(text, scope)):
                    continue
                out, at = [], 0
                for start, end, _ in spans:
                    if start >= at:
                        out += [text[at:start], mark]
                    at = max(at, end)
                texts[i] = "".join([*out, text[at:]])
                sizes[i] = len(texts[i])
            arrays = [batch.column(0), pa.array(texts, pa.string()), batch.column(2), batch.column(3), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=list(DOCUMENT_COLUMNS))

    return docs.select(*columns).mapInArrow(cleaned, "doc_id long, text string, lang string, source string, n_chars long")

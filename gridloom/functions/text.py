"""Text of fetched bodies: charset, HTML to text, links."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of texts that a Python worker turns into Python values at once (more only where one text has more).
PART_BYTES = 1 << 20
LINK = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])


@F.pandas_udf(T.StringType())
def _decoded(bodies: pd.Series, charsets: pd.Series) -> pd.Series:
    def decode(body: bytes | None, charset: str) -> str | None:
        try:
            return None if body is None else body.decode(charset, "replace")
        except LookupError:
            return body.decode("utf-8", "replace")

    return pd.Series([decode(b, c) for b, c in zip(bodies, charsets, strict=True)], dtype=object)


def decode_body(body: Column, content_type: Column) -> Column:
    """Text of a body by the charset of its content type, bad bytes replaced; bodies in UTF-8 are decoded in the JVM and reach Python as null."""
    charset = F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset=([\w.-]+)", 1))
    utf8 = charset.isin("", "utf-8", "utf8")
    return F.when(utf8, F.make_valid_utf8(body.cast("string"))).otherwise(_decoded(F.when(~utf8, body), charset))


def decode_code_file(content: Column, encoding: Column) -> Column:
    """Text of a code file: base64 is unpacked, a plain string passes."""
    return F.when(encoding == "base64", F.make_valid_utf8(F.unbase64(content).cast("string"))).otherwise(content)


def in_parts(f: Callable[..., list], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``f`` of lists of values over a whole Arrow batch, in parts of bounded size: only the batch and the result are held whole, both as Arrow buffers."""
    n, done = len(columns[0]), []
    rows = max(1, PART_BYTES * n // max(1, sum(c.nbytes for c in columns)))
    at = 0
    while at < n:
        part = [c.slice(at, rows) for c in columns]
        while len(part[0]) > 1 and sum(c.nbytes for c in part) > 2 * PART_BYTES:  # here texts are longer than elsewhere
            part = [c.slice(0, len(c) // 2) for c in part]
        done.append(pa.array(f(*(c.to_pylist() for c in part)), kind))
        at += len(part[0])
    return pa.concat_arrays(done) if done else pa.array([], kind)


@F.arrow_udf(T.StringType())
def _unescaped(texts: pa.Array) -> pa.Array:
    import html

    return in_parts(lambda part: [None if t is None else html.unescape(t) for t in part], pa.string(), texts)


def _without_tags(markup: Column) -> Column:
    text = F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.regexp_replace(text, r"<[^>]+>", " ")


def html_to_text(markup: Column) -> Column:
    """Text without scripts, styles and tags; only the no-break space is unescaped."""
    text = F.replace(F.replace(_without_tags(markup), F.lit("&nbsp;"), F.lit(" ")), F.lit(" "), F.lit(" "))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def html_to_text_unescaped(markup: Column) -> Column:
    """As ``html_to_text``, with all entities unescaped; texts without ``&`` reach Python as null."""
    text = _without_tags(markup)
    text = F.when(text.contains("&"), _unescaped(F.when(text.contains("&"), text))).otherwise(text)
    return F.trim(F.regexp_replace(F.replace(text, F.lit(" "), F.lit(" ")), r"(?U)\s+", " "))


@F.arrow_udf(T.ArrayType(LINK))
def extract_links(markup: pa.Array, base: pa.Array) -> pa.Array:
    """Anchors with an href, in order: joined URL and text with collapsed space. An anchor never closed is dropped."""
    from html.parser import HTMLParser
    from urllib.parse import urljoin

    class Anchors(HTMLParser):
        def __init__(self, base_url: str):
            super().__init__(convert_charrefs=True)
            self.base_url, self.found, self.url, self.words = base_url, [], None, []

        def handle_starttag(self, tag, attrs):
            href = {k.lower(): v for k, v in attrs if v is not None}.get("href") if tag == "a" else None
            if href:
                self.url, self.words = urljoin(self.base_url, href), []

        def handle_data(self, data):
            if self.url:
                self.words.append(data)

        def handle_endtag(self, tag):
            if tag == "a" and self.url:
                text = " ".join(" ".join(self.words).split())
                self.found.append({"pos": len(self.found), "url": self.url, "text": text})
                self.url = None

    def links(html: str | None, base_url: str | None) -> list[dict]:
        parser = Anchors(base_url or "")
        parser.feed(html or "")
        return parser.found

    kind = pa.list_(pa.struct([("pos", pa.int32()), ("url", pa.string()), ("text", pa.string())]))
    return in_parts(lambda pages, bases: [links(h, b) for h, b in zip(pages, bases, strict=True)], kind, markup, base)

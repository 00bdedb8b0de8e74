"""Derived WARC records: metadata and plain text of response records.

For every response, two records that refer to it: a ``metadata`` record with the
source's headers, title, links and digests as JSON, and a ``conversion`` record with
its text. Both keep the response's URI and date, and have digests of their own.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import query, rarely, table

# Elements without text to show, and those that end a line.
HIDDEN = ("script", "style", "noscript", "template", "iframe", "object", "svg", "head")
BLOCKS = (
    "address", "article", "aside", "blockquote", "br", "center", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "option", "p", "pre", "section", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
)
RAW = ("script", "style")   # run to the end of the page if nothing ends them
_OPEN = re.compile(rf"<!--|<({'|'.join(HIDDEN)})(?=[\s/>])", re.I)
_CLOSE = {n: re.compile(rf"</{n}\b", re.I) for n in HIDDEN}
_BLANK = re.compile(r"\s*")
_META = re.compile(r"<(?:meta|link|base)\b", re.I)
_TITLE = re.compile(r"<title\b", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_LINE = re.compile(rf"</?(?:{'|'.join(BLOCKS)})\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>")
_SPACE = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_LINK = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>\"']+")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)

RECORD = "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_digest string, source_headers string, block string"
NAMES = [x.split()[0] for x in RECORD.split(", ")]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(*parts: str) -> str:
    """A record id that follows from its parts, so that a repeated task gives it again."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=4)}>"


class Scan:
    """Searches that go forward through a page. What isn't found from one place on isn't
    sought again from a later one, so that a page of openings that nothing ends is read
    a few times and not once for each of them."""

    def __init__(self, page: str):
        self.page, self.gone = page, set()

    def find(self, mark: str, at: int) -> int:
        i = -1 if mark in self.gone else self.page.find(mark, at)
        if i < 0:
            self.gone.add(mark)
        return i

    def search(self, pattern: re.Pattern, at: int) -> re.Match | None:
        m = None if pattern in self.gone else pattern.search(self.page, at)
        if m is None:
            self.gone.add(pattern)
        return m

    def tag_end(self, at: int) -> int:
        """The place after the next ``>``; -1, if there is none."""
        return self.find(">", at) + 1 or -1

    def closed(self, name: str, at: int) -> int:
        """The place after the element's end tag; -1, if there is none."""
        m = self.search(_CLOSE[name], at)
        return -1 if m is None else self.tag_end(m.end())

    def title(self, m: re.Match) -> tuple[int, int, int]:
        """Where a title's text starts and ends, and the place after it; -1 each, if
        nothing ends it."""
        start = self.tag_end(m.end())
        end = self.search(_TITLE_END, start) if start >= 0 else None
        return (-1, -1, -1) if end is None else (start, end.start(), end.end())

    def head_part(self, at: int) -> int:
        """The place after a head's own element at ``at``; -1, if something else is there."""
        if m := _META.match(self.page, at):
            return self.tag_end(m.end())
        if m := _TITLE.match(self.page, at):
            return self.title(m)[2]
        return -1


def closes_itself(tag: str) -> bool:
    """Whether a tag ends in a slash that isn't part of an unquoted value."""
    if not tag.endswith("/>"):
        return False
    at = len(tag) - 2
    while at and not tag[at - 1].isspace() and tag[at - 1] not in "\"'":
        at -= 1
    name, equals, value = tag[at:-2].partition("=")
    return not (value if equals else name and tag[:at].rstrip().endswith("="))


def shown(page: str) -> str:
    """The page without comments and ``HIDDEN`` elements. What nothing ends runs to the end
    of the page for comments, scripts and styles; an open head ends where something other
    than its own elements starts, and of other elements only the tag goes. Tags that close
    themselves hold nothing. Time is in proportion to the page, whatever it holds."""
    scan, out, at, kept, in_head = Scan(page), [], 0, 0, False
    while True:
        if in_head:
            after = at
            while after >= 0:
                at = kept = _BLANK.match(page, after).end()
                after = scan.head_part(at)
        m = _OPEN.search(page, at)
        end = -1 if m is None or m[1] is None else scan.tag_end(m.end())
        if m is not None and m[1] and end < 0:
            at = m.end()   # not a tag: nothing closes it
            in_head = False
            continue
        in_head = in_head and m is not None and m.start() == at
        if m is None:
            return "".join([*out, page[kept:]])
        out.append(page[kept : m.start()])
        at = m.end() if m[1] is None else end
        if m[1] is None:
            end = scan.find("-->", at)
            at = len(page) if end < 0 else end + 3
        elif not closes_itself(page[m.start() : end]):
            name = m[1].lower()
            close = scan.closed(name, at)
            if close >= 0:
                at = close
            else:
                if name in RAW:
                    at = len(page)
                in_head = in_head or name == "head"
        kept = at


def page_title(page: str) -> str | None:
    m = _TITLE.search(page)
    start, end, _ = Scan(page).title(m) if m else (-1, -1, -1)
    return _SPACE.sub(" ", html.unescape(page[start:end])).strip() if start >= 0 else None


def links(page: str) -> list[str]:
    """The targets of a page's links, as they stand there but for entities."""
    scan, out, at = Scan(page), [], 0
    while m := scan.search(_LINK, at):
        end = scan.tag_end(m.end())
        # The last tag may run to the end of the page.
        at = end = end if end >= 0 else len(page)
        for h in _HREF.finditer(page, m.end(), end):
            quote = page[h.end() : h.end() + 1]
            if quote in ("'", '"') and quote:
                close = scan.find(quote, h.end() + 1)
                found, stop = (page[h.end() + 1 : close], close + 1) if close >= 0 else (None, 0)
            else:
                bare = _BARE.match(page, h.end(), end)
                found, stop = (bare[0], bare.end()) if bare else (None, 0)
            if found is not None:
                out.append(html.unescape(found))
                at = stop
                break
    return out


def plain_text(page: str) -> str:
    """What a reader sees of a page: a line for each block, single spaces, characters
    for entities."""
    page = shown(page)
    last = page.rfind(">") + 1   # no tag ends beyond it
    page = _TAG.sub("", _LINE.sub("\n", page[:last])) + page[last:]
    page = _SPACE.sub(" ", html.unescape(page))
    return _LINES.sub("\n", page).strip()


def split_message(message: bytes) -> tuple[str, bytes]:
    """HTTP headers and body; a message without an empty line is a body alone."""
    head, gap, body = message.partition(b"\r\n\r\n")
    return (head.decode("latin-1"), body) if gap and head[:5].upper() == b"HTTP/" else ("", message)


def body_text(headers: str, body: bytes) -> str:
    """The body as text, by the charset that headers or page name, else UTF-8; bytes
    that make no character become U+FFFD."""
    said = _CHARSET.search(headers) or _CHARSET.search(body[:1024].decode("latin-1"))
    try:
        return body.decode(said[1] if said else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def derive(page_id, record_id: str | None, uri: str | None, date: str | None, message: bytes | None) -> list[tuple]:
    """The two records of one response. Missing parts count as empty."""
    message = message or b""
    headers, body = split_message(message)
    page = body_text(headers, body)
    text = plain_text(page)
    source = digest(body)
    facts = {
        "source_record": record_id, "uri": uri, "date": date, "http_headers": headers.split("\r\n") if headers else [],
        "payload_digest": source, "payload_length": len(body),
        "title": page_title(page), "links": links(shown(page)), "text_length": len(text.encode()),
    }
    out = []
    for kind, mime, block in (("metadata", "application/json", json.dumps(facts, ensure_ascii=False)), ("conversion", "text/plain; charset=UTF-8", text)):
        data = block.encode("utf-8", "replace")
        name = record_name(kind, str(record_id), source)
        out.append((page_id, kind, name, record_id, uri, date, mime, len(data), digest(data), source, headers, data.decode()))
    return out


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows for each row of ``responses`` (page_id, record_id, target_uri, warc_date,
    message binary): the columns of ``RECORD``; ``block`` is the record's content.

    * NULL or empty messages give records of an empty page; NULL ids, URIs and dates
      stay NULL in the records that refer to them.
    * Repeated responses give repeated records with equal ids.
    * Other columns aren't read. No row needs another, so nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rarely(batches):
            rows = [r for x in zip(*(batch[c].to_pylist() for c in ("page_id", "record_id", "target_uri", "warc_date", "message"))) for r in derive(*x)]
            kinds = [pa.int64() if n in ("page_id", "content_length") else pa.string() for n in NAMES]
            cols = list(zip(*rows)) or [[] for _ in NAMES]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], NAMES)

    names = [F.col("page_id").cast("long").alias("page_id"), *(F.col(c).cast("string").alias(c) for c in ("record_id", "target_uri", "warc_date")), F.col("message").cast("binary").alias("message")]
    return responses.select(*names).mapInArrow(run, RECORD)


def responses_of(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as response records: an HTTP message for each, with a
    date since the table has none. NULL html is an empty body."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n")
    ).cast("binary")
    h = F.sha2(F.concat_ws("\0", F.lit("response"), F.col("page_id").cast("string"), F.col("url")), 256)
    name = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))
    return pages.select("page_id", name.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), F.concat(head, body).alias("message"))


def record_bytes(row: dict) -> bytes:
    """A derived record as it stands in a WARC file."""
    block = row["block"].encode()
    named = (
        ("WARC-Type", row["warc_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Refers-To", row["refers_to"]), ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Date", row["warc_date"]), ("WARC-Block-Digest", row["block_digest"]), ("WARC-Source-Payload-Digest", row["source_digest"]),
        ("Content-Type", row["content_type"]), ("Content-Length", str(len(block))),
    )
    clean = lambda v: re.sub(r"[\r\n]+", " ", v)
    head = "WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in named if v is not None)
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def as_files(records: DataFrame, path: str, gz: bool = True) -> None:
    """Write derived records as WARC content: a table of one binary column ``value``, a
    record in each row, gzipped by itself, so that the rows of a file joined together
    are a WARC file."""
    import gzip

    @F.arrow_udf("binary")
    def pack(rows: pa.Array) -> pa.Array:
        data = [record_bytes(r) for r in rows.to_pylist()]
        return pa.array([gzip.compress(d, mtime=0) for d in data] if gz else data, pa.binary())

    records.select(pack(F.struct(*NAMES)).alias("value")).write.mode("overwrite").parquet(path)


@query("op9_warc_derivatives")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses_of(table(spark, sf_dir, "pages")))

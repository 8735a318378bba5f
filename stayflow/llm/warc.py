"""WARC derivatives: linked metadata and plain-text conversion records from responses.

For every response record a ``metadata`` record (fields about the page, the source's HTTP
headers among them) and a ``conversion`` record (the page's text) are made. Both keep the
target URI and date, refer to the response by WARC-Refers-To, carry the response's payload
digest as a source digest, and have block and payload digests of their own. Record ids are
name-based UUIDs, so a lost task makes the same records again. A task works on its own rows;
nothing is shuffled.

Defined results: null html or url counts as empty; a page without text gives a conversion
record with an empty block; every input row gives one response, one metadata and one
conversion record (repeated rows give the same records again); an empty table gives none.
A page is read from left to right once, whatever it holds: an unclosed tag or comment is
looked for to the page's end only once. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html as html_lib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import bounded_batches, map_arrow, table

#: Name space of the record ids.
RECORDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:stayflow:warc")
#: The date of pages that come without one, so that records are the same in every run.
DATE = "2024-01-01T00:00:00Z"

_OPEN = re.compile(r"<!--|<(script|style|template|noscript)\b", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "template", "noscript")}
_BREAK = re.compile(r"<(?:/?(?:p|div|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|main"
                    r"|aside|blockquote|pre|title|head|body|html|dl|dt|dd|form|figure)|br|hr)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
#: What matters for counting links: a tag opens, gives an address, or ends.
_LINK = re.compile(r"(<a\b)|(\bhref\s*=)|>", re.I)
#: Longer character numbers than any character has.
_NUMBER = re.compile(r"&#([0-9]{20,})")


def _cut(tags: re.Pattern, by: str, text: str) -> str:
    """``text`` with ``tags`` replaced; none can end after the last ``>``."""
    last = text.rfind(">") + 1
    return tags.sub(by, text[:last]) + text[last:]


def _visible(page: str) -> str:
    """``page`` with a space for each comment, script, style, template and noscript element;
    one that is not closed goes on to the end."""
    out, done, at, last = [], 0, 0, page.rfind(">")
    while found := _OPEN.search(page, at):
        at = found.end()
        if found[1] is None:
            end = page.find("-->", at)
            end = len(page) if end < 0 else end + 3
        elif at <= last:
            close = _CLOSE[found[1].casefold()].search(page, page.find(">", at) + 1)
            end = close.end() if close else len(page)
        else:
            continue  # the tag itself does not end
        out += page[done:found.start()], " "
        done = at = end
    out.append(page[done:])
    return "".join(out)


def _unescape(text: str) -> str:
    """Character references resolved, numbers of any length among them."""
    return html_lib.unescape(_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), text))


def page_text(page: str) -> str:
    """The text of a page: no scripts, styles, comments or tags; a line per block element."""
    text = _cut(_TAG, "", _cut(_BREAK, "\n", _visible(page)))
    return _LINES.sub("\n", _BLANKS.sub(" ", _unescape(text))).strip(" \n")


def page_title(page: str) -> str:
    """The text of the first title element that is closed, on one line."""
    start = _TITLE.search(page)
    inner = page.find(">", start.end()) + 1 if start else 0
    end = _TITLE_END.search(page, inner) if inner else None
    return " ".join(_unescape(_cut(_TAG, "", page[inner:end.start()])).split()) if end else ""


def count_links(page: str) -> int:
    """Number of ``a`` tags with an ``href``."""
    links, inside = 0, False
    for found in _LINK.finditer(page):
        if found[1]:
            inside = True
        else:
            links += inside and bool(found[2])
            inside = False
    return links


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORDS, chr(10).join(parts))}>"


def header(fields: list[tuple[str, str]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)


RESPONSE = ("page_id long, record_id string, target_uri string, date string, http_headers string, "
            "payload string, payload_digest string")
DERIVED = ("page_id long, type string, record_id string, refers_to string, concurrent_to string, "
           "target_uri string, date string, source_digest string, source_headers string, "
           "content_type string, content_length long, block_digest string, header string, block string")


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[t]) for c, (_, t) in zip(cols, names)], [n for n, _ in names])


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of a page table (columns of RESPONSE)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches):
        for batch in bounded_batches(batches, 2):
            out = []
            for page, url, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8", "surrogatepass")
                sha = digest(raw)
                http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(raw)}\r\n")
                # one line each: an address cannot add header fields
                url = " ".join(url.split())
                out.append((page, record_id("response", str(page), url, sha), url, date, http, text, sha))
            yield _arrow(out, RESPONSE)

    return map_arrow(rows, run, RESPONSE)


def derivatives(found: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records (columns of DERIVED)."""
    names = [c.split()[0] for c in RESPONSE.split(", ")]

    def run(batches):
        for batch in bounded_batches(batches, names.index("payload")):
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                out += derive(*row)
            yield _arrow(out, DERIVED)

    return map_arrow(found.select(*names), run, DERIVED)


def derive(page, source: str, uri: str, date: str, http: str, payload: str, sha: str) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    text = page_text(payload)
    meta_id, text_id = record_id("metadata", source), record_id("conversion", source)
    lines = [f"source-{k.strip().lower()}: {v.strip()}" for k, _, v in
             (x.partition(":") for x in http.split("\r\n")[1:] if x)]
    meta = "\r\n".join(
        [f"source-status: {http.split(chr(13))[0]}", *lines, f"source-payload-digest: {sha}",
         f"title: {page_title(payload)}", f"links: {count_links(payload)}",
         f"text-length: {len(text)}", f"conversion-record: {text_id}"]) + "\r\n"
    out = []
    for kind, own, other, content, block in (
            ("metadata", meta_id, text_id, "application/warc-fields", meta),
            ("conversion", text_id, meta_id, "text/plain; charset=utf-8", text)):
        raw = block.encode("utf-8", "surrogatepass")
        sha_block = digest(raw)
        fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date),
                  ("WARC-Target-URI", uri), ("WARC-Refers-To", source), ("WARC-Concurrent-To", other),
                  ("WARC-Source-Payload-Digest", sha), ("WARC-Block-Digest", sha_block),
                  ("WARC-Payload-Digest", sha_block), ("Content-Type", content),
                  ("Content-Length", str(len(raw)))]
        out.append((page, kind, own, source, other, uri, date, sha, http, content, len(raw),
                    sha_block, header(fields), block))
    return out


def write_warc(records: DataFrame, path: str) -> None:
    """Records (header, block) as WARC files, one for each partition, by Spark's own writer.
    A record ends with two CRLF, the last LF of which is the writer's line end."""
    records.select(F.concat("header", F.lit("\r\n"), "block", F.lit("\r\n\r"))).write.mode(
        "overwrite").option("lineSep", "\n").text(path)


def read_warc(spark, path: str) -> DataFrame:
    """path, header, block of the records in WARC files; a file is read whole by one task, and
    a record without Content-Length is an error that names the file."""
    def run(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _records(name, raw.as_buffer())

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_arrow(files, run, "path string, header string, block binary")


def _records(name: str, raw) -> object:
    data, at = memoryview(raw), 0
    whole = bytes(data)
    while (end := whole.find(b"\r\n\r\n", at)) >= 0:
        head = whole[at:end + 2].decode()
        length = re.search(r"(?im)^Content-Length: *(\d+)\r$", head)
        if length is None:
            raise ValueError(f"{name}: a record at byte {at} has no Content-Length")
        size = int(length[1])
        block = whole[end + 4:end + 4 + size]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([head]), pa.array([block])], ["path", "header", "block"])
        at = end + 4 + size + 4


def op5_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    made = derivatives(responses(table(spark, sf_dir, "pages")))
    return made.select("page_id", "type", "record_id", "refers_to", "concurrent_to", "target_uri",
                       "source_digest", "content_type", "content_length", "block_digest",
                       F.sha2(F.concat("header", "block"), 256).alias("record_sha256"))

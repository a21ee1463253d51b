"""WARC derivatives: response records become metadata and plain-text conversion records.

``responses`` wraps pages into WARC/1.1 response records (bytes with WARC and
HTTP heads).  ``derive`` takes such records from any source, one a row, and
gives for each response

* a ``conversion`` record: the readable text of an HTML or text payload, and
* a ``metadata`` record (``application/warc-fields``): title, links, HTTP
  status, the source's digests and its HTTP heads, one field a line.

Both name the response in ``WARC-Refers-To`` (with its target URI and date),
carry its digests on as ``source-...`` fields, and point at each other with
``WARC-Concurrent-To``.  Record ids follow from the response's id, so a rerun
writes the same records.  ``write`` stores records as WARC files with Spark's
text writer, whose line end is the record end.

Defined results: a record that is no response gives nothing; a payload that is
neither HTML nor text, or a status other than 200, gives a metadata record only; a null or empty
payload converts to empty text; a null URL leaves the URI heads out; a payload
digest that does not fit its payload is reported in ``digest-mismatch`` and the
record is kept; repeated rows give repeated records; bytes that do not decode
become U+FFFD; heads may end in bare line feeds.  Work is linear in a page's
length, also where tags, titles or anchors are opened and never closed.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_END = b"\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace
_DROP = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b.*?(?:</\1\s*>|\Z)|<head\b.*?(?:</head\s*>|(?=<body\b)|\Z)")
_BREAK = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|header|footer|blockquote|pre|hr|title|body)\b[^>]*>")
_TAG = re.compile(r"(?s)<[a-zA-Z/!?][^>]*>")
_TITLE = re.compile(r"(?i)<title\b")
_TITLE_END = re.compile(r"(?i)</title\s*>")
_ANCHOR = re.compile(r"(?i)<a\b")
_HREF = re.compile(r"""(?is)[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_BEYOND = re.compile(r"&#[1-9][0-9]{7,};?")
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_LENGTH = re.compile(r"[0-9]{1,18}")
_CHUNK = re.compile(rb"([0-9A-Fa-f]{1,15})[^\n]*\n")
_PIECE = 1 << 14
_BLANK = re.compile(r"[^\S\n]+")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record(heads: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without the two line ends that close it; heads without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in heads if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + 2 * _END + block


def _heads(raw: bytes) -> tuple[str, list[tuple[str, str]]]:
    first, *rest = re.split(r"\r?\n", raw.decode("utf-8", "replace"))
    out: list[tuple[str, str]] = []
    for line in rest:
        if line[:1] in " \t" and out:  # a folded head goes on
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return first, out


def _parted(raw: bytes) -> tuple[bytes, bytes]:
    """What stands before and after the first empty line."""
    m = _HEAD_END.search(raw)
    return (raw[: m.start()], raw[m.end() :]) if m else (raw, b"")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The heads (names lower-cased) and the block of a record."""
    head, block = _parted(raw)
    heads = {k.lower(): v for k, v in _heads(head)[1]}
    length = heads.get("content-length", "")
    return heads, block[: int(length)] if _LENGTH.fullmatch(length) else block


def _unzipped(payload: bytes, bits: int, members: bool) -> bytes | None:
    """The members' contents up to what is not compressed; None if that is the whole payload."""
    out, at = [], 0
    try:
        while at < len(payload):
            member = zlib.decompressobj(bits)
            while at < len(payload) and not member.eof:  # in pieces: a member gives back what follows it
                piece = payload[at : at + _PIECE]
                out.append(member.decompress(piece))
                at += len(piece) - len(member.unused_data)
            if not members:
                break
    except zlib.error:  # not compressed, or padding after the last member
        pass
    return b"".join(out) if out else None


def _body(heads: dict[str, str], payload: bytes) -> bytes:
    if heads.get("transfer-encoding", "").lower() == "chunked":
        out, at = [], 0
        while (m := _CHUNK.match(payload, at)) and (n := int(m[1], 16)):
            out.append(payload[m.end() : m.end() + n])
            at = m.end() + n
            at += 2 if payload[at : at + 2] == _END else 1
        payload = b"".join(out)
    coding = heads.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip", "deflate"):
        plain = _unzipped(payload, 47 if "gzip" in coding else 15, "gzip" in coding)
        payload = payload if plain is None else plain
    return payload


def _unescaped(text: str) -> str:
    """Entities resolved; numbers of any length, those beyond Unicode as U+FFFD."""
    return html.unescape(_BEYOND.sub("\ufffd", _ZEROS.sub("&#", text)) if "&#" in text else text)


def _without(tags: re.Pattern[str], by: str, text: str) -> str:
    """The text with its tags replaced; after the last ``>`` no tag ends, so none is looked for."""
    end = text.rfind(">") + 1
    return tags.sub(by, text[:end]) + text[end:]


def readable(markup: str) -> str:
    """The text a reader sees: blocks on lines of their own, blanks collapsed, entities resolved."""
    text = _without(_TAG, " ", _without(_BREAK, "\n", _DROP.sub(" ", markup)))
    lines = (_BLANK.sub(" ", x).strip() for x in _unescaped(text).split("\n"))
    return "\n".join(x for x in lines if x)


def _title(markup: str) -> str | None:
    """The first title; if its tag or it has no end, no later one has."""
    m = _TITLE.search(markup)
    start = markup.find(">", m.end()) + 1 if m else 0
    end = _TITLE_END.search(markup, start) if start else None
    return " ".join(_unescaped(_without(_TAG, " ", markup[start : end.start()])).split()) if end else None


def _links(markup: str) -> list[str]:
    """The targets of the anchors; an anchor without one is left at its ``>``, as those it holds have none either."""
    out, at = [], 0
    while m := _ANCHOR.search(markup, at):
        if href := _HREF.match(markup, m.end()):
            out.append(" ".join(_unescaped(next(filter(None, href.groups()), "")).split()))
            at = href.end()
        elif not (at := markup.find(">", m.end()) + 1):
            break
    return [x for x in dict.fromkeys(out) if x]


def derivatives(raw: bytes | None) -> list[dict]:
    """The conversion and metadata records of one response record."""
    if not raw:
        return []
    heads, block = parse(raw)
    if heads.get("warc-type") != "response":
        return []
    head, payload = _parted(block)
    status, http = _heads(head)
    of = {k.lower(): v for k, v in http}
    body = _body(of, payload)
    kind = of.get("content-type", "text/html").lower()
    charset = re.search(r"charset=[\"']?([\w.:-]+)", kind)
    try:
        markup = body.decode(charset[1] if charset else "utf-8", "replace").encode("utf-8", "replace").decode()
    except (LookupError, UnicodeError):  # no text encoding of that name
        markup = body.decode("utf-8", "replace")
    code = (status.split() + ["", ""])[1]
    source, uri, date = heads.get("warc-record-id"), heads.get("warc-target-uri"), heads.get("warc-date")
    of_source = source or "urn:sha1:" + hashlib.sha1(raw).hexdigest()
    ids = {t: f"<{uuid.uuid5(_NAMESPACE, f'{of_source} {t}').urn}>" for t in ("conversion", "metadata")}
    is_html = "html" in kind
    converted = code == "200" and (is_html or kind.startswith("text/"))
    own = digest(payload)
    told = heads.get("warc-payload-digest")
    carried = [("source-payload-digest", told or own), ("source-block-digest", heads.get("warc-block-digest") or digest(block))]
    fields = [("title", _title(markup) if is_html else None), ("http-status", code), *carried,
              ("digest-mismatch", own if told and told.startswith("sha1:") and told != own else None),
              *((f"http-{k.lower()}", v) for k, v in http)]
    links = _links(markup) if is_html else []
    fields += [("outlink", x) for x in links]
    blocks = {"metadata": "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)}
    if converted:
        blocks = {"conversion": readable(markup) if is_html else markup, **blocks}
    out = []
    for t, text in blocks.items():
        content = text.encode("utf-8", "replace")
        other = next((ids[x] for x in blocks if x != t), None)
        mark = digest(content)
        made = record([
            ("WARC-Type", t), ("WARC-Record-ID", ids[t]), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source),
            ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Concurrent-To", other), ("WARC-Block-Digest", mark),
            *(carried if t == "conversion" else []),
            ("Content-Type", "text/plain; charset=utf-8" if t == "conversion" else "application/warc-fields")], content)
        out.append({"record_type": t, "record_id": ids[t], "refers_to": source, "target_uri": uri, "block_digest": mark,
                    "source_digest": told or own, "block": text, "n_links": len(links), "record": made.decode("utf-8", "replace")})
    return out


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """page_id and its response record (bytes)."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, uri, markup in zip(*(c.to_pylist() for c in b.columns)):
                payload = (markup or "").encode("utf-8", "replace")
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                uri = None if uri is None else " ".join(uri.split())
                out.append(record([
                    ("WARC-Type", "response"), ("WARC-Record-ID", f"<{uuid.uuid5(_NAMESPACE, f'{key} {uri}').urn}>"), ("WARC-Date", date),
                    ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
                    ("Content-Type", "application/http; msgtype=response")], block))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["page_id", "record"])

    return pages.select(F.col(page_id), F.col(url).cast("string"), F.col(body).cast("string")).mapInArrow(run, f"page_id {kind}, record binary")


_FIELDS = {"record_type": "string", "record_id": "string", "refers_to": "string", "target_uri": "string", "block_digest": "string",
           "source_digest": "string", "block": "string", "n_links": "bigint", "record": "string"}


def derive(records: DataFrame, key: str = "page_id", column: str = "record") -> DataFrame:
    """The key with every derived record: type, id, refers-to, URI, digests, block, number of links, whole record."""
    kind = records.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [derivatives(raw) for raw in b.column(1).to_pylist()]
            at = [i for i, x in enumerate(made) for _ in x]
            flat = [y for x in made for y in x]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int32())), *(pa.array([y[f] for y in flat], pa.int64() if t == "bigint" else pa.string()) for f, t in _FIELDS.items())],
                names=["page_id", *_FIELDS])

    return records.select(F.col(key), F.col(column)).mapInArrow(run, f"page_id {kind}, " + ", ".join(f"{k} {t}" for k, t in _FIELDS.items()))


def write(derived: DataFrame, folder: str) -> None:
    """WARC files of the derived records; a record ends with two line ends."""
    derived.select(F.col("record").alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)

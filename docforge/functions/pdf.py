"""Text and facts of PDF files: a documented subset without a PDF library.

Read are classic files with plain or Flate-coded streams, literal and hexadecimal strings, outlines and
the information dictionary. Encrypted files, object streams and font encodings beyond Latin-1 are not;
their pages count as empty.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_PAGE_CHARS = 5000
_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_SHOW = re.compile(rb"\[((?:\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|[^\[\]()<>])*)\]\s*TJ|(\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>)\s*(?:Tj|'|\")|(T\*|(?:Td|TD|ET)\b)", re.S)
_STRING = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def string(raw: bytes) -> str:
    """The characters of a PDF string."""
    if raw[:1] == b"<":
        digits = re.sub(rb"\s", b"", raw[1:-1])
        data = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode("ascii"))
    else:
        data = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else b"" if m[1].strip() == b"" else _ESCAPES.get(m[1], m[1]), raw[1:-1], flags=re.S)
    return data[2:].decode("utf-16-be", "replace") if data[:2] == b"\xfe\xff" else data.decode("latin-1")


def _stream(body: bytes) -> bytes:
    m = _STREAM.search(body)
    if not m:
        return b""
    if b"FlateDecode" in body[: m.start()]:
        try:
            return zlib.decompressobj().decompress(m[1])
        except zlib.error:
            return b""
    return m[1]


def shown(content: bytes) -> str:
    """The text that a content stream shows, lines apart."""
    out = []
    for array, single, step in _SHOW.findall(content):
        if step:
            out.append("\n")
        else:
            out.append("".join(string(s) for s in _STRING.findall(array)) if array else string(single))
    return "\n".join(x for x in (" ".join(line.split()) for line in "".join(out).split("\n")) if x)


def _entry(body: bytes, key: bytes) -> str | None:
    m = re.search(rb"/" + key + rb"\s*(\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>)", body, re.S)
    return string(m[1]) if m else None


#: Further facts of a file and their keys in it; dates stay as they are written.
ABOUT = {"subject": b"Subject", "creator": b"Creator", "producer": b"Producer", "creation_date": b"CreationDate", "modification_date": b"ModDate"}


def read(data: bytes | None) -> dict:
    """text (pages apart by a blank line), page_count, is_scanned, title, author, the facts of ``ABOUT``, toc of (title, level), error."""
    fail = {"text": "", "first_page": "", "page_count": 0, "is_scanned": True, "title": None, "author": None, **dict.fromkeys(ABOUT), "toc": [], "error": "not a PDF file"}
    if not data or b"%PDF" not in data[:1024]:
        return fail
    objects = {int(n): body for n, body in _OBJECT.findall(data)}
    pages = [b for b in objects.values() if re.search(rb"/Type\s*/Page\b", b)]
    if not pages:
        return fail | {"error": "no page"}
    texts = []
    for page in pages:
        m = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", page)
        parts = [_stream(objects.get(int(n), b"")) for n in _REF.findall(m[1])] if m else []
        texts.append(shown(b"\n".join(parts)))
    info = re.search(rb"/Info\s+(\d+)\s+\d+\s+R", data)
    about = objects.get(int(info[1]), b"") if info else b""
    text = "\n\n".join(t for t in texts if t)
    return {"text": text, "first_page": texts[0][:FIRST_PAGE_CHARS], "page_count": len(pages), "is_scanned": not text, "title": _entry(about, b"Title"), "author": _entry(about, b"Author"), **{k: _entry(about, v) for k, v in ABOUT.items()}, "toc": outline(objects), "error": None}


def outline(objects: dict[int, bytes]) -> list[tuple[str, int]]:
    """Titles of the outline with their level, from 0, in order."""
    root = next((b for b in objects.values() if re.search(rb"/Type\s*/Outlines\b", b)), None)
    ref = lambda body, key: int(m[1]) if body and (m := re.search(rb"/" + key + rb"\s+(\d+)\s+\d+\s+R", body)) else None
    out, seen = [], set()
    todo = [(ref(root, b"First"), 0)]
    while todo:
        at, level = todo.pop()
        if at is None or at in seen or at not in objects:
            continue
        seen.add(at)
        body = objects[at]
        if (name := _entry(body, b"Title")) is not None:
            out.append((name, level))
        todo += [(ref(body, b"Next"), level), (ref(body, b"First"), level + 1)]
    return out


def parse_pdfs(df: DataFrame, id_col: str, bytes_col: str = "content_bytes") -> DataFrame:
    """(id, text, first_page, page_count, is_scanned, title, author, the facts of ``ABOUT``, toc, error) of files given as bytes."""
    fields = ["text", "first_page", "page_count", "is_scanned", "title", "author", *ABOUT, "toc", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), *(pa.string() for _ in ABOUT), pa.list_(pa.struct([("title", pa.string()), ("level", pa.int32())])), pa.string()]
        for b in batches:
            done = [read(x) for x in b.column("c").to_pylist()]
            for x in done:
                x["toc"] = [{"title": t, "level": v} for t, v in x["toc"]]
            yield pa.RecordBatch.from_arrays([b.column("k"), *(pa.array([x[f] for x in done], t) for f, t in zip(fields, kinds))], ["k", *fields])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("k"), F.col(bytes_col).alias("c"))
    return picked.mapInArrow(run, f"k {kind}, text string, first_page string, page_count int, is_scanned boolean, title string, author string, " + "".join(f"{x} string, " for x in ABOUT) + "toc array<struct<title: string, level: int>>, error string").withColumnRenamed("k", id_col)

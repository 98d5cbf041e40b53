"""Problem 4: text decoded with the wrong character encoding.

Characters are mapped back to the bytes of a legacy code page by a lookup table; over those bytes runs
the automaton of well-formed UTF-8 (a lead byte and its one to three followers), on whole arrays of
characters at once. A sequence counts by evidence: it decodes to a character that can stand alone, or
next to it is another one of the same script, of whatever language; the maximal spans of such sequences
are decoded and nothing else, again and again while spans remain, since text can be garbled more than
once. What no longer has its bytes (U+FFFD, C1 controls from a code page, cut sequences, one legacy page
read as another) is found by its traces; Cyrillic read by another page only if its letters are likelier so.
"""

from __future__ import annotations

import codecs
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.arrow import codepoints, slices

#: Code pages that text is taken to have been read in. The first stands for Latin-1, too: bytes it leaves open are C1 controls.
PAGES = ("cp1252", "cp1251", "mac_roman", "cp437", "cp850", "koi8-r", "cp1250")
#: Garbling is undone at most so many times over.
PASSES = 4

#: Characters that ordinary text in any language holds one at a time: a single sequence may stand for one of them.
_ALONE = ((0x80, 0xFF), (0x152, 0x153), (0x160, 0x161), (0x178, 0x178), (0x17D, 0x17E), (0x192, 0x192), (0x2C6, 0x2C6), (0x2DC, 0x2DC), (0x401, 0x45F), (0x900, 0x97F), (0x2000, 0x206F), (0x20A0, 0x20CF), (0x2100, 0x214F), (0x2190, 0x22FF), (0x2500, 0x259F), (0xFB00, 0xFB06), (0xFEFF, 0xFEFF), (0xFFFD, 0xFFFD))
_tables: dict[str, np.ndarray] = {}


def page_table(page: str) -> np.ndarray:
    """Byte of each character up to U+FFFF in a code page; 0 where there is none."""
    if page not in _tables:
        out = np.zeros(0x10000, dtype=np.uint8)
        for b in range(0x80, 0x100):
            try:
                c = ord(bytes([b]).decode(page))
            except UnicodeDecodeError:
                c = b
            out[c] = b
        if page == "cp1252":
            free = np.arange(0x80, 0xA0)
            out[free] = free
        _tables[page] = out
    return _tables[page]


def kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(may stand alone, letter or mark, assigned) of each code point."""
    if "alone" not in _tables:
        names = [unicodedata.category(chr(c)) for c in range(0x110000)]
        _tables["letter"] = np.fromiter((x[0] in "LM" for x in names), dtype=bool, count=len(names))
        _tables["assigned"] = np.fromiter((x not in ("Cn", "Co", "Cs") for x in names), dtype=bool, count=len(names))
        alone = np.zeros(0x110000, dtype=bool)
        for a, b in _ALONE:
            alone[a : b + 1] = True
        alone[0x10000:] = True  # four bytes in a row are no accident
        _tables["alone"] = alone & _tables["assigned"]
    return _tables["alone"], _tables["letter"], _tables["assigned"]


def sequences(cp: np.ndarray, page: str, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, decoded character) of each well-formed multibyte sequence that counts.

    ``ends`` are the ends of the texts that ``cp`` joins, each closed by a character outside of all pages.
    A sequence counts by itself if it decodes to a character that may stand alone, unless it is what right text
    can hold; next to another one of the same script; and where such ones are in the same text.
    """
    b = page_table(page)[np.minimum(cp, 0xFFFF)]
    high = np.flatnonzero((b >= 0xC2) & (b <= 0xF4))
    high = high[high + 1 < len(b)]
    high = high[(b[high + 1] & 0xC0) == 0x80]
    if not len(high):
        return high, high, high
    alone, letter, assigned = kinds()
    x = np.concatenate((b, np.zeros(3, b.dtype)))
    b0, b1, b2, b3 = (x[high + k].astype(np.int64) for k in range(4))
    size = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
    third, fourth = (b2 & 0xC0) == 0x80, (b3 & 0xC0) == 0x80
    value = np.where(size == 2, (b0 & 0x1F) << 6 | b1 & 0x3F, np.where(size == 3, (b0 & 0xF) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F, (b0 & 7) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F))
    fine = (size == 2) | ((size == 3) & third & (value >= 0x800)) | ((size == 4) & third & fourth & (value >= 0x10000) & (value < 0x110000))
    fine &= assigned[np.minimum(value, 0x10FFFF)]
    at, size, value = high[fine], size[fine], value[fine]
    if not len(at):
        return at, size, value
    script = np.where(value >= 0x10000, 3, np.where(value >= 0x2E80, 2, np.where(value < 0x250, 1, value >> 7 << 2)))
    touch = at[1:] == at[:-1] + size[:-1]
    alike = touch & (script[1:] == script[:-1]) & letter[value[1:]] & letter[value[:-1]]
    linked, chain = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
    linked[1:] |= touch
    linked[:-1] |= touch
    chain[1:] |= alike
    chain[:-1] |= alike
    before, first, second = cp[np.maximum(at - 1, 0)], cp[at], cp[at + 1]
    after = cp[np.minimum(at + size, len(cp) - 1)]
    single = alone[value] & ((script < 4 << 1) | (value < 0x401) | (value > 0x45F) | linked)  # one Cyrillic letter is no word
    if page in ("cp1252", "cp1250"):
        # an accented capital before a closing quotation mark, after a capital
        closing = (second >= 0x2013) & (second <= 0x201D) | (second == 0xBB) | (second == 0x2026)
        capital = (before >= 65) & (before <= 90) | (before >= 0xC0) & (before <= 0xDE) | np.isin(before, (0xAB, 0x2018, 0x201C, 0x201E))
        single &= linked | ~(closing & capital & ~letter[after]) | (size > 2)
    else:
        # two letters of right text: all of a sequence's characters are letters
        latin = lambda c: (c >= 65) & (c <= 90) | (c >= 97) & (c <= 122)
        inside = (first > 0x24F) & (value < 0x250) & (latin(before) | latin(after))  # letters of another script inside a Latin word
        wide = cp[np.maximum(at - 2, 0)], cp[np.minimum(at + size + 1, len(cp) - 1)]
        inside |= (first > 0x24F) & (value >= 0xC0) & (value < 0x100) & (before == 32) & (after == 32) & latin(wide[0]) & latin(wide[1])  # or between Latin words
        single &= linked | ~(letter[first] & letter[second]) | inside | (size > 2)
    if page == "cp1251":
        # an upper-case letter before a quotation mark, inside a Cyrillic word, is ordinary Russian
        single &= linked | ~((before >= 0x400) & (before < 0x460) & (at > 0))
    ok = single | chain
    if chain.any() and not ok.all():
        text = np.searchsorted(ends, at, side="right") if ends is not None else np.zeros(len(at), dtype=np.int64)
        key = text * 0x10000 + script
        ok |= np.isin(key, key[chain]) & (linked | ~letter[before] | ~letter[after])
    return at[ok], size[ok], value[ok]


# Letters of Russian text by frequency, in hundredths of a per cent.
_RUSSIAN = dict(zip("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", (1097, 845, 801, 735, 670, 626, 547, 473, 454, 440, 349, 321, 298, 281, 262, 201, 190, 174, 170, 165, 159, 144, 121, 97, 94, 73, 64, 48, 36, 32, 26, 4, 4)))
_PLAUSIBLE = {c: math.log(n / 100) for c, n in _RUSSIAN.items()}
_UNLIKELY = -4.0


def plausible(text: str) -> float:
    """How far the letters of a text are those of Russian, by their mean log frequency."""
    letters = [c for c in text.lower() if c.isalpha()]
    return sum(_PLAUSIBLE.get(c, _UNLIKELY) for c in letters) / max(1, len(letters))


def _other_page(source: str, target: str) -> dict[int, str]:
    """Each high character of a code page as its byte reads in another one."""
    out = {}
    for b in range(0x80, 0x100):
        x, y = bytes([b]).decode(source, "ignore"), bytes([b]).decode(target, "ignore")
        if x and y and x != "\xa0":
            out[ord(x)] = y
    return out


_SWAPS = tuple(_other_page(a, b) for a, b in (("koi8-r", "cp1251"), ("cp1251", "koi8-r")))
_ONE_BYTE = tuple(_other_page("latin-1", p) for p in ("cp1251", "koi8-r", "iso8859-5"))
_LATIN = _other_page("cp1251", "cp1252")

# Bytes that were replaced, or Windows punctuation read as Latin-1.
_LOST = re.compile("[\ufffd\x80-\x9f]")
# What is left of a sequence of three that stood for a quotation mark or dash, one of its characters gone.
_CUT_THREE = re.compile("â\\??[€‚ƒ„†‡ˆ‰Š‹ŒŽ•˜™š›œžŸ¬¹]|(?<![^\\W\\d_])â\\??[‘’“”–—…]|â\\?[‘’“”–—…]")
# What is left of a sequence of two: the second character was replaced, or was a blank that can't be told.
_CUT_TWO = re.compile("(?<![A-ZÀ-Þ])[ÃÂ]\\?|(?<=[a-zß-ÿ])[ÃÂ](?![A-ZÀ-Þ])")
# Runs of accented letters only: Cyrillic of one byte a letter read as Latin.
_ACCENTED = re.compile("(?<![A-Za-z])[À-ÿ]+(?:[^A-Za-zÀ-ÿ]+[À-ÿ]+)*(?![A-Za-z])")
# Words whose cases are swapped: one Cyrillic page read as another.
_SWAPPED = re.compile("(?<![Ѐ-ӿ])[а-яё]?[А-ЯЁ]+(?![Ѐ-ӿ])(?:[\\W\\d_]+[а-яё]?[А-ЯЁ]+(?![Ѐ-ӿ]))*")
_LOW_HIGH = re.compile("(?<![Ѐ-ӿ])[а-яё][А-ЯЁ]+(?![Ѐ-ӿ])")
# Cyrillic letters inside Latin words: Latin of one byte read as Cyrillic.
_MIXED = re.compile("(?<=[A-Za-z])[Ѐ-ӿ]{1,2}(?=[a-z])|(?<![Ѐ-ӿ\\w])[Ѐ-ӿ](?=[a-z]{2})|(?<=[a-z]{3})й(?!\\w)")


def _decoded_run(m: re.Match) -> str | None:
    """A run of accented letters as Cyrillic, if that is what it is."""
    if not re.search("[À-ÖØ-öø-ÿ]{3}", m[0]):
        return None
    n = sum("À" <= c <= "ÿ" for c in m[0])
    best = max((m[0].translate(t) for t in _ONE_BYTE), key=lambda t: plausible(t) + (0.5 if t[1:] == t[1:].lower() else 0))
    return best if (n >= 4 and plausible(best) >= 1.25) or (n >= 6 and plausible(best) >= 0.8) else None


def _unswapped(m: re.Match) -> str | None:
    """Words with swapped cases as the other Cyrillic page has them, if that is more likely."""
    if not _LOW_HIGH.search(m[0]):
        return None
    best = max((m[0].translate(t) for t in _SWAPS), key=plausible)
    n = sum(c.isalpha() for c in m[0])
    gain = plausible(best) - plausible(m[0])
    return best if gain >= 0.4 and gain * n >= 3 else None


def traced(text: str) -> bool:
    """Whether a text holds what is left of wrongly decoded characters whose bytes can't be read off any more."""
    return (
        _LOST.search(text) is not None
        or _CUT_THREE.search(text) is not None
        or _CUT_TWO.search(text) is not None
        or _MIXED.search(text) is not None
        or any(_decoded_run(m) for m in _ACCENTED.finditer(text))
        or any(_unswapped(m) for m in _SWAPPED.finditer(text))
    )


def trace_count(text: str) -> int:
    """How many traces a text holds."""
    regular = sum(1 for p in (_LOST, _CUT_THREE, _CUT_TWO, _MIXED) for _ in p.finditer(text))
    return regular + sum(len(m[0]) for p, f in ((_ACCENTED, _decoded_run), (_SWAPPED, _unswapped)) for m in p.finditer(text) if f(m))


def _classes() -> np.ndarray:
    """Bits of each character up to U+FFFF: 1 lost, 2 accented, 4 ASCII letter, 8 and 16 lower and upper Cyrillic, 32 â, 64 Ã or Â."""
    if "classes" not in _tables:
        out = np.zeros(0x10000, dtype=np.uint8)
        out[0x80:0xA0] = out[0xFFFD] = 1
        out[0xC0:0x100] = 2
        out[0xD7] = out[0xF7] = 0
        out[65:91] = out[97:123] = 4
        out[0x400:0x430], out[0x430:0x500] = 16, 8
        out[0xE2] |= 32
        out[0xC2] |= 64
        out[0xC3] |= 64
        _tables["classes"] = out
    return _tables["classes"]


def _suspects(cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The texts in which a trace is possible, from pairs of neighbouring characters."""
    x = _classes()[np.minimum(cp, 0xFFFF)]
    at = [np.flatnonzero(x & (1 | 64)), np.flatnonzero((x[:-2] & 2) & (x[1:-1] & 2) & (x[2:] & 2))]
    left, right = x[:-1], x[1:]
    at.append(np.flatnonzero(((left & 4) != 0) & ((right & 24) != 0) | ((left & 24) != 0) & ((right & 4) != 0) | ((left & 8) != 0) & ((right & 16) != 0)))
    follow = cp[1:]
    at.append(np.flatnonzero(((left & 32) != 0) & ((follow == 63) | (follow >= 0x80) & (x[1:] & 2 == 0))))
    return np.unique(np.searchsorted(ends, np.concatenate(at), side="right"))


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    cp = codepoints("\0".join(texts) + "\0")
    return cp, np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))


def any_sequence(texts: list[str]) -> np.ndarray:
    """For each text, whether the automaton accepts a span in it."""
    cp, ends = _joined(texts)
    hit = np.zeros(len(texts), dtype=bool)
    for page in PAGES:
        at, _, _ = sequences(cp, page, ends)
        if len(at):
            hit[np.searchsorted(ends, at, side="right")] = True
    return hit


def garbled(texts: list[str | None]) -> np.ndarray:
    """For each text, whether it holds wrongly decoded characters; null and empty ones don't."""
    which = [i for i, t in enumerate(texts) if t and not t.isascii()]
    out = np.zeros(len(texts), dtype=bool)
    if which:
        some = [texts[i] for i in which]
        found = any_sequence(some)
        for i in _suspects(*_joined(some)):
            if not found[i]:
                found[i] = traced(some[i])
        out[which] = found
    return out


def restore(text: str) -> str:
    """The text with its spans decoded, by the code page that explains most characters in each pass."""
    for _ in range(PASSES):
        cp = codepoints(text + "\0")
        best, most = None, 0
        for page in PAGES:
            at, size, value = sequences(cp, page)
            if len(at) and size.sum() > most:
                best, most = (at, size, value), size.sum()
        if best is None:
            break
        at, size, value = best
        out = cp.astype(np.uint32).copy()
        keep = np.ones(len(cp), dtype=bool)
        keep[-1] = False
        out[at] = value
        for k in (1, 2, 3):
            keep[at[size > k] + k] = False
        text = out[keep].tobytes().decode("utf-32-le", "surrogatepass")
    text = _ACCENTED.sub(lambda m: _decoded_run(m) or m[0], text)
    # Windows punctuation that went through as C1 controls
    text = re.sub("[\x80-\x9f]", lambda m: m[0].encode("latin-1").decode("cp1252", "ignore") or m[0], text)
    text = _CUT_THREE.sub(_punctuation, text)
    # the second half of à is a blank, or was replaced
    text = re.sub("(?<=[a-zß-ÿ])Ã(?:\\?|(?=[\\s.,;:)]|$))", "à", text)
    text = _MIXED.sub(lambda m: m[0].translate(_LATIN), text)
    return _SWAPPED.sub(lambda m: _unswapped(m) or m[0], text)


def _punctuation(m: re.Match) -> str:
    """The quotation mark or dash of whose three characters the second is gone; one with two bytes gone stays."""
    b = m[0][-1].encode("cp1252", "ignore")
    return bytes((0xE2, 0x80)).__add__(b).decode("utf-8", "ignore") or m[0] if b and b != b"\x80" else m[0]


_META = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)


def declared(headers, data: bytes) -> str:
    """The charset of the content-type header, else of the page's meta element, else UTF-8; unknown names are passed over."""
    names = [m[1] for k, v in headers or () if k and v and k.lower() == "content-type" and (m := re.search(r"charset\s*=\s*[\"']?\s*([^\s;\"',]+)", v, re.I))]
    meta = _META.search(data[:4096]) or _META.search(data)
    for name in [*names, *([meta[1].decode("ascii")] if meta else [])]:
        try:
            return codecs.lookup(name).name
        except LookupError:
            continue
    return "utf-8"


def decoded(headers, data: bytes) -> tuple[str, bool]:
    """The page's text as declared, and whether all its bytes were well-formed."""
    charset = declared(headers, data)
    try:
        return data.decode(charset), True
    except (UnicodeError, LookupError):
        return data.decode("utf-8" if charset in ("undefined", "idna", "punycode") else charset, "replace"), False


def garbled_records(df: DataFrame, id_col: str = "doc_id", text_col: str = "clean_text") -> DataFrame:
    """The ids of rows whose text holds wrongly decoded characters, each once. Nulls and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            hit = garbled(part.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("k").filter(pa.array(hit))], ["k"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.col("t").rlike(r"[^\x00-\x7f]"))
    return picked.mapInArrow(run, f"k {kind}").distinct().withColumnRenamed("k", id_col)


def restored_records(df: DataFrame, id_col: str = "doc_id", text_col: str = "clean_text") -> DataFrame:
    """(id, text, restored) of the affected rows, each once: the text with all decodable spans decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            texts = part.column("t").to_pylist()
            hit = garbled(texts)
            mask = pa.array(hit)
            yield pa.RecordBatch.from_arrays([part.column("k").filter(mask), part.column("t").filter(mask), pa.array([restore(t) for t, h in zip(texts, hit) if h], type=pa.string())], ["k", "t", "restored"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.col("t").rlike(r"[^\x00-\x7f]")).dropDuplicates(["k"])
    return picked.mapInArrow(run, f"k {kind}, t string, restored string").withColumnsRenamed({"k": id_col, "t": text_col})


def garbled_pages(df: DataFrame, id_col: str = "raw_id", bytes_col: str = "content_bytes", headers_col: str = "headers", status_col: str = "http_status") -> DataFrame:
    """The ids of fetched pages (status 200) whose bytes, decoded as declared, don't give the text as written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "c"):
            texts, bad = [], []
            for data, head in zip(part.column("c").to_pylist(), part.column("h").to_pylist()):
                text, fine = decoded(head, data) if data else ("", True)
                texts.append(text)
                bad.append(not fine or "\0" in text)  # zeros: two-byte text read as bytes
            hit = garbled(texts) | np.array(bad, dtype=bool)
            yield pa.RecordBatch.from_arrays([part.column("k").filter(pa.array(hit))], ["k"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.where(F.col(status_col) == 200).select(F.col(id_col).alias("k"), F.col(bytes_col).alias("c"), F.col(headers_col).alias("h")).where(F.length("c") > 0)
    return picked.mapInArrow(run, f"k {kind}").distinct().withColumnRenamed("k", id_col)


#: Single-byte code pages tried where the declared charset doesn't give the text.
FALLBACKS = ("cp1252", "cp1251", "koi8-r", "iso8859-5", "cp1250", "mac_roman")
_MULTI = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_HIGH = re.compile(rb"[\x80-\xff]")


def _wide(data: bytes) -> str | None:
    """The charset of two-byte text, by its mark or by where its zeros are; None for other text."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    even, odd = data[:4096:2].count(0), data[1:4096:2].count(0)
    least = len(data[:4096]) // 8
    return "utf-16-le" if odd > max(least, 2 * even) else "utf-16-be" if even > max(least, 2 * odd) else None


def _stray(e: UnicodeDecodeError) -> tuple[str, int]:
    """A single byte outside of UTF-8 is Windows text; what is left of a cut sequence is lost."""
    return ("\ufffd" if e.end - e.start > 1 else e.object[e.start : e.end].decode("cp1252", "replace")), e.end


codecs.register_error("docforge-stray", _stray)


def original(headers, data: bytes) -> str:
    """The page's text as it was written, as far as its bytes have it.

    Two-byte text is told by its mark or zeros; where most high bytes lie in well-formed UTF-8, those spans are
    decoded as such; else the declared charset or the code page is taken that leaves the fewest traces. What
    was garbled before the page was stored is then undone as in records.
    """
    wide = _wide(data)
    high = len(_HIGH.findall(data))
    if wide:
        text = data.decode(wide, "replace")
    elif not high or 2 * sum(map(len, _MULTI.findall(data))) > high:
        text = data.decode("utf-8", "docforge-stray")
    else:
        tried = []
        for page in dict.fromkeys((declared(headers, data), *FALLBACKS)):
            try:
                tried.append(data.decode(page, "replace" if page in FALLBACKS else "strict"))
            except (UnicodeError, LookupError):
                pass
        text = min(tried, key=trace_count)
    text = text.removeprefix("\ufeff")
    return restore(text) if garbled([text])[0] else text


def restored_pages(df: DataFrame, id_col: str = "raw_id", bytes_col: str = "content_bytes", headers_col: str = "headers", status_col: str = "http_status") -> DataFrame:
    """(id, text, restored) of the pages of ``garbled_pages``, each once: the text as declared, and as written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "c"):
            pages = list(zip(part.column("h").to_pylist(), part.column("c").to_pylist()))
            read = [decoded(head, data) for head, data in pages]
            hit = garbled([t for t, _ in read]) | np.array([not fine or "\0" in t for t, fine in read], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [part.column("k").filter(pa.array(hit)), pa.array([t for (t, _), h in zip(read, hit) if h], type=pa.string()), pa.array([original(*p) for p, h in zip(pages, hit) if h], type=pa.string())],
                ["k", "t", "restored"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.where(F.col(status_col) == 200).select(F.col(id_col).alias("k"), F.col(bytes_col).alias("c"), F.col(headers_col).alias("h")).where(F.length("c") > 0)
    return picked.mapInArrow(run, f"k {kind}, t string, restored string").dropDuplicates(["k"]).withColumnsRenamed({"k": id_col, "t": "text"})

"""Problem 5: printed lines, page furniture and misrecognised characters in text from scanned paper.

Words are grouped by a skeleton in which glyphs that recognition confuses are alike; in each group the
form that is frequent over the whole corpus supports the rare ones that differ from it by one confusion,
and of several such forms the neighbouring words decide.
Running headers are lines that are alike once digits are masked, next to page numbers or set apart by
form. A word broken at a line's end is one if the joined form, not the hyphenated one, is in use.
Vocabulary and headers are counted over all documents by shuffled aggregates; reflow uses a window over
the lines of each document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docforge.io import materialise
from docforge.llm.arrow import slices

# A right glyph and what it is misread as.
CONFUSIONS = (("l", "1"), ("i", "1"), ("o", "0"), ("s", "5"), ("a", "@"), ("e", "c"), ("i", "l"), ("l", "i"), ("t", "f"), ("u", "ii"), ("n", "u"), ("m", "rn"), ("rn", "m"), ("d", "cl"), ("cl", "d"), ("g", "q"), ("h", "b"), ("b", "h"), ("h", "li"), ("li", "h"), ("ri", "n"), ("n", "ri"), ("w", "vv"), ("b", "6"), ("g", "9"), ("fi", "ﬁ"), ("fl", "ﬂ"))
#: A form is misread if the one it stands for is in use so often at least, and it so rarely: up to RARE plus a share.
SUPPORT = 10
RARE = 2
RARE_SHARE = 0.01
#: So many of the words too frequent to be misread forms are not sent through the join (the result is the same without).
TOP_WORDS = 1000
#: Up to so many misread forms are told to the tasks that read pages, and the neighbours of so many are looked for in one
#: pass over the texts; more are joined, and take several passes.
MOST_FORMS = 100_000
#: A line next to page numbers is furniture if its like stands there in so many documents.
LEAST_DOCUMENTS = 5

_LIGATURES = str.maketrans({"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"})
# Glyphs that are alike go to the same strokes.
_ALIKE = str.maketrans({"1": "i", "|": "i", "!": "i", "l": "i", "r": "i", "0": "o", "5": "s", "@": "a", "9": "q", "g": "q", "m": "iii", "n": "ii", "u": "ii", "w": "vv", "d": "ci", "h": "ii", "b": "ii", "6": "ii", "e": "c", "f": "t"})
_BREAKS = frozenset("-\xad¬‐")
_STRIP = ".,;:()“”„\"«»?¿¡…—–-‐¬\xad•[]‘’'/%§€₹£$\x0c"
_PIECES = re.compile(r"(?<=\w)[–—/’'](?=\w)")
_LETTER = re.compile(r"[^\W\d_]")
_NUMBER = re.compile(r"^\W*(?:(?:p\.|pp\.|page|seite|s\.|pág(?:ina)?\.?|pagina|pag\.|стр\.|страница|पृष्ठ)\s*)?(?:[\dOolI]{1,5}|[ivxlc1]{1,9})(?:\s*(?:of|/|von|de|di|sur|из)\s*\d+)?\W*$", re.I)
_BAR = re.compile(r"^\d{1,5} \| \S|\S \| \d{1,5}$")
_GAP = re.compile(r"\S {3,}\S")
_FIGURES = re.compile(r"^[\d.,%+()$€₹£ \t-]+$")


def skeleton(word: str) -> str:
    return word.lower().translate(_LIGATURES).translate(_ALIKE)


def one_confusion(word: str, right: str) -> int:
    """Where ``word`` differs from ``right`` by one misread glyph; -1 if it doesn't."""
    for good, bad in CONFUSIONS:
        at = word.find(bad)
        while at >= 0:
            if word[:at] + good + word[at + len(bad) :] == right:
                return at
            at = word.find(bad, at + 1)
    return -1


#: Words of the tokens seen last; the table starts anew when it is full.
_TOKENS: dict[str, list[str]] = {}
_MOST_TOKENS = 200_000


def words(line: str) -> list[str]:
    """The words of a line in lower case without surrounding punctuation, hyphenated ones whole and in parts."""
    out = []
    for token in line.split():
        found = _TOKENS.get(token)
        if found is None:
            if len(_TOKENS) >= _MOST_TOKENS:
                _TOKENS.clear()
            found = _TOKENS[token] = _token_words(token)
        out += found
    return out


def _token_words(token: str) -> list[str]:
    out = []
    for t in _PIECES.split(token):
        t = t.strip(_STRIP).lower()
        if len(t) > 1 and _LETTER.search(t):
            out.append(t)
            if "-" in t or "‐" in t:
                out += [x for x in re.split("[-‐]", t) if len(x) > 1 and _LETTER.search(x)]
    return out


def broken(line: str) -> bool:
    end = line.rstrip()[-2:]
    return end[1:] in _BREAKS and _LETTER.match(end) is not None


def shape(line: str) -> str:
    """blank, number (a page number), header (set apart by its form) or text."""
    s = line.strip()
    if not s:
        return "blank"
    if _NUMBER.match(s) or _BAR.search(s):
        return "number"
    if _FIGURES.match(s):
        return "text"
    letters = [c for c in s if c.isalpha()]
    if _GAP.search(s) and len(letters) > 3:
        return "header"
    upper, lower = sum(c.isupper() for c in letters), sum(c.islower() for c in letters)
    if upper > 3 and lower <= s.count("l") + s.count("i") and lower * 4 <= upper and not s.endswith("."):
        return "header"
    return "text"


def header_key(line: str) -> str:
    return skeleton(re.sub(r"\d+", "#", line.strip()))


def read_page(text: str) -> list[tuple[int, str, str, str, int]]:
    """(line, kind, key, other key, place) of what one document's lines show.

    Kinds: furniture; near, a line next to a page number, with its key; hyphen; join, a word broken at a
    hyphen, with the joined and the hyphenated form; word; cut, a word in two lines and where it is cut,
    with the number of the second line as other key.
    """
    lines = text.split("\n")
    kind = [shape(x) for x in lines]
    out: list[tuple[int, str, str, str, int]] = []
    def apart(j: int) -> bool:
        """Whether a text line could be furniture: it starts large and doesn't end a clause."""
        s = lines[j].strip()
        return kind[j] == "text" and s[0].isupper() and s[-1] not in ".,;:" and not broken(s)

    beside = lambda j: j == len(lines) - 1 or any(kind[i] in ("number", "header") for i in (j - 1, j + 1) if 0 <= i < len(lines))
    near = {j: header_key(lines[j]) for j in range(len(lines)) if kind[j] == "text" and beside(j) and apart(j)}
    often = Counter(near.values())
    for j, key in near.items():
        if often[key] > 1:
            kind[j] = "header"
        else:
            out.append((j + 1, "near", key, "", 0))
    for i, k in enumerate(kind):
        if k in ("number", "header"):
            out.append((i + 1, "furniture", "", "", 0))
    skip = set()  # lines whose first word is the rest of a broken one
    for i, line in enumerate(lines):
        if kind[i] != "text":
            continue
        found = line.split()
        if i in skip:
            found = found[1:]
        if broken(line):
            nxt = next((j for j in range(i + 1, len(lines)) if kind[j] == "text" and j not in near), None)
            rest = lines[nxt].strip().split()[0] if nxt is not None else ""
            if rest and _LETTER.match(rest) and not rest[0].isupper():
                skip.add(nxt)
                mark = line.rstrip()[-1]
                head = re.split(r"[\s–—/’'(“\"«]", line.rstrip())[-1][:-1].lstrip(_STRIP)
                tail = re.split(r"[\s–—/’']", rest)[0].rstrip(_STRIP)
                whole = (head + tail).lower()
                if mark in "\xad¬":
                    out.append((i + 1, "hyphen", "", "", 0))
                else:
                    out.append((i + 1, "join", whole, f"{head}-{tail}".lower(), int(head[:1].isupper())))
                last = re.split("[-‐]", head)[-1]
                first = re.split("[-‐]", tail)[0]
                if len(last + first) > 1 and _LETTER.search(last + first):
                    out.append((i + 1, "cut", (last + first).lower(), str(nxt + 1), len(last)))
                found = found[:-1]
        out += [(i + 1, "word", w, "", 0) for w in set(words(" ".join(found)))]
    return out


def paged(url: Column) -> Column:
    """Whether a url's path ends in .pdf."""
    return F.lower(F.regexp_extract(url, r"^[^?#]*", 0)).endswith(".pdf")


def vocabulary(docs: DataFrame, text_col: str = "body_text") -> DataFrame:
    """(word, skeleton, n) over all documents; the two parts of a word broken at a line's end don't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            count: Counter = Counter()
            for text in part.column("t").to_pylist():
                cut = False
                for line in text.split("\n"):
                    again, cut = cut, line[-3:].rstrip()[-1:] in _BREAKS and broken(line)
                    if again or cut:
                        line = " ".join(line.split()[int(again) : -1 if cut else None])
                    count.update(words(line))
            keys = list(count)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([skeleton(w) for w in keys], pa.string()), pa.array([count[w] for w in keys], pa.int64())], ["word", "skeleton", "n"])

    picked = docs.select(F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    return picked.mapInArrow(run, "word string, skeleton string, n bigint").groupBy("word", "skeleton").agg(F.sum("n").alias("n"))


def readings(vocab: DataFrame) -> DataFrame:
    """(word, right, most, place) of forms that may stand for a frequent one, with how often that is used and where they differ."""
    used = vocab.where(F.col("n") >= SUPPORT).select("skeleton", F.col("word").alias("right"), F.col("n").alias("most"))
    pairs = vocab.join(used, "skeleton").where((F.col("word") != F.col("right")) & (F.col("n") <= RARE + F.col("most") * RARE_SHARE)).select("word", "right", "most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, r = b.column("word").to_pylist(), b.column("right").to_pylist()
            at = [one_confusion(x, y) for x, y in zip(w, r)]
            keep = [i for i, k in enumerate(at) if k >= 0]
            yield pa.RecordBatch.from_arrays([pa.array([w[i] for i in keep], pa.string()), pa.array([r[i] for i in keep], pa.string()), b.column("most").take(pa.array(keep, pa.int64())), pa.array([at[i] for i in keep], pa.int32())], ["word", "right", "most", "place"])

    return pairs.mapInArrow(run, "word string, right string, most bigint, place int")


def misread(near: DataFrame) -> DataFrame:
    """(word, right, place): of several readings the most frequent one, where no neighbours are looked at."""
    return near.groupBy("word").agg(F.max_by(F.struct("right", "place"), F.struct("most", "right")).alias("x")).select("word", "x.right", "x.place")


def neighbours(docs: DataFrame, forms: set[str], by_document: bool, id_col: str, text_col: str) -> DataFrame:
    """(k, form, side, word, n): the words next to ``forms`` on their line, in each document, or in all (k is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            count: Counter = Counter()
            for k, text in zip(part.column("k").to_pylist(), part.column("t").to_pylist()):
                for line in text.split("\n"):
                    found = words(line)
                    for i, w in enumerate(found):
                        if w in forms:
                            own = k if by_document else None
                            if i:
                                count[own, w, -1, found[i - 1]] += 1
                            if i + 1 < len(found):
                                count[own, w, 1, found[i + 1]] += 1
            cols = list(zip(*count)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], part.schema.field("k").type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string()), pa.array(list(count.values()), pa.int64())], ["k", "form", "side", "word", "n"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    return picked.mapInArrow(run, f"k {kind}, form string, side int, word string, n bigint").groupBy("k", "form", "side", "word").agg(F.sum("n").alias("n"))


def in_context(docs: DataFrame, near: DataFrame, id_col: str, text_col: str, url_col: str) -> DataFrame | None:
    """(k, word, right) for forms with several readings: the one that the words next to it in the document support.

    A reading's probability is that of its use, times that of each neighbour beside it over all texts. None if no form
    has several readings.
    """
    several = materialise(near.join(near.groupBy("word").agg(F.count("*").alias("c")).where("c > 1").select("word"), "word", "left_semi"), "several")
    passes = -(-several.select(F.explode(F.array("word", "right"))).distinct().count() // MOST_FORMS)
    out = None
    for n in range(passes):
        own = several.where(F.pmod(F.xxhash64("word"), F.lit(passes)) == n)
        forms = own.select("word", "right").distinct().collect()
        left = neighbours(docs.where(paged(F.col(url_col))), {r["word"] for r in forms}, True, id_col, text_col)
        right = neighbours(docs, {r["right"] for r in forms}, False, id_col, text_col).select(F.col("form").alias("right"), "side", F.col("word").alias("beside"), F.col("n").alias("together"))
        x = left.select("k", F.col("form").alias("word"), "side", F.col("word").alias("beside"), "n").join(own, "word").join(right, ["right", "side", "beside"], "left")
        each = F.col("n") * F.log((F.coalesce("together", F.lit(0)) + 0.1) / F.col("most"))
        score = x.groupBy("k", "word", "right").agg((F.sum(each) + F.log(F.max("most"))).alias("score"))
        best = score.groupBy("k", "word").agg(F.max_by("right", F.struct("score", "right")).alias("right"))
        out = best if out is None else out.unionByName(best)
    return out


def corrected(text: str, fix: dict[str, str]) -> str:
    """A paragraph with its misread words put right, in the case that they are written in."""

    def one(word: str) -> str:
        core = word.strip(_STRIP)
        low = core.lower()
        right = fix.get(low)
        if right is None and ("-" in core or "‐" in core):
            return word.replace(core, "".join(one(x) if x not in "-‐" else x for x in re.split("([-‐])", core) if x), 1)
        if right is None:
            return word
        letters = [c for c in core if c.isalpha()]
        if len(letters) > 1 and all(c.isupper() for c in letters):
            right = right.upper()
        elif core[0].isupper():
            right = right[0].upper() + right[1:]
        return word.replace(core, right, 1)

    return "".join(x if i % 2 else one(x) for i, x in enumerate(re.split(r"(\s+|(?<=\w)[–—/’'](?=\w))", text)))


def signs(docs: DataFrame, id_col: str, text_col: str, top: set[str], wanted: set[str] | None = None) -> DataFrame:
    """What ``read_page`` finds in each document; of words only those wanted, or all but the most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            ids, rows = [], []
            for k, text in zip(part.column("k").to_pylist(), part.column("t").to_pylist()):
                new = [x for x in read_page(text) if x[1] != "word" or (x[2] not in top if wanted is None else x[2] in wanted)]
                ids += [k] * len(new)
                rows += new
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(ids, part.schema.field("k").type), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int32())], ["k", "line_no", "kind", "key", "other", "at"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    return picked.mapInArrow(run, f"k {kind}, line_no int, kind string, key string, other string, at int")


def faults(docs: DataFrame, id_col: str = "doc_id", text_col: str = "body_text", url_col: str = "url") -> DataFrame:
    """(id, line_no, fault) with the faults furniture, hyphen and ocr of paged documents, each once.

    Lines are what lies between ``\\n``, from 1. Null and blank texts have none; a document delivered twice
    counts once in the result. Other columns are left out; an empty table gives an empty result.
    """
    return _faults(docs, id_col, text_col, url_col)[0]


def _faults(docs: DataFrame, id_col: str, text_col: str, url_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    vocab = materialise(vocabulary(docs, text_col), "vocabulary")
    near_forms = materialise(readings(vocab), "readings")
    wrong = materialise(misread(near_forms), "misread")
    # a word that is no misread form shows nothing; few forms are told to the tasks, many are found by the join below
    wanted = {r["word"] for r in wrong.select("word").collect()} if wrong.count() <= MOST_FORMS else None
    top: set[str] = set()
    if wanted is None:
        most = vocab.agg(F.max("n")).first()[0] or 0
        top = {r[0] for r in vocab.where(F.col("n") > RARE + most * RARE_SHARE).orderBy(F.desc("n"), "word").limit(TOP_WORDS).select("word").collect()}
    seen = materialise(signs(docs.where(paged(F.col(url_col))), id_col, text_col, top, wanted), "signs")
    near = seen.where("kind = 'near'").select("k", "line_no", "key")
    known = near.groupBy("key").agg(F.count_distinct("k").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS).select("key")
    furniture = seen.where("kind = 'furniture'").select("k", "line_no").union(near.join(known, "key", "left_semi").select("k", "line_no")).distinct()
    # a break at a hyphen: compare the joined with the hyphenated form, and fall back on the two parts
    joins = seen.where("kind = 'join'").select("k", "line_no", "key", "other", F.col("at").alias("upper")).distinct()
    asked = joins.select(F.explode(F.array("key", "other", F.substring_index("other", "-", 1), F.substring_index("other", "-", -1))).alias("word")).distinct()
    counts = vocab.join(asked, "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n"))

    def counted(df: DataFrame, key: Column, name: str) -> DataFrame:
        return df.withColumn("__w", key).join(counts.select(F.col("word").alias("__w"), F.col("n").alias(name)), "__w", "left").drop("__w").na.fill(0, [name])

    j = counted(counted(joins, F.col("key"), "whole"), F.col("other"), "compound")
    j = counted(counted(j, F.substring_index("other", "-", 1), "first"), F.substring_index("other", "-", -1), "second")
    small = F.col("upper") == 0  # a name is no compound
    keeps = (F.col("compound") > F.col("whole")) | (small & (F.col("whole") == 0) & (F.col("first") >= SUPPORT) & (F.col("second") >= SUPPORT))
    hyphen = seen.where("kind = 'hyphen'").select("k", "line_no").union(j.where(~keeps).select("k", "line_no"))
    read = seen.where("kind IN ('word', 'cut')").select("k", "line_no", "kind", F.col("key").alias("word"), "other", "at").join(wrong, "word")
    line = F.when((F.col("kind") == "cut") & (F.col("place") >= F.col("at")), F.col("other").cast("int")).otherwise(F.col("line_no"))
    ocr = read.select("k", line.alias("line_no"))
    rest = hyphen.select("k", "line_no", F.lit("hyphen").alias("fault")).union(ocr.select("k", "line_no", F.lit("ocr").alias("fault"))).distinct()
    rest = rest.join(furniture, ["k", "line_no"], "left_anti")
    out = furniture.select("k", "line_no", F.lit("furniture").alias("fault")).union(rest).withColumnRenamed("k", id_col)
    return out, wrong, seen, near_forms


def repaired(docs: DataFrame, id_col: str = "doc_id", text_col: str = "body_text", url_col: str = "url") -> DataFrame:
    """(id, paragraph_no, text): the paragraphs of paged documents, without furniture, with words joined and misread ones corrected.

    Paragraphs are told apart by blank or indented lines. Words are put right after the lines are joined, so that broken
    ones are, too, and keep their case; of several readings the one that the document's neighbouring words support is
    taken. A document delivered twice counts once.
    """
    out, wrong, seen, near = _faults(docs, id_col, text_col, url_col)
    out = materialise(out, "faults")
    pages = docs.where(paged(F.col(url_col)) & F.col(text_col).isNotNull()).select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).dropDuplicates(["k"])
    lines = pages.select("k", F.posexplode(F.split("t", "\n", -1)).alias("at", "line")).withColumn("line_no", F.col("at") + 1)
    gone = out.where("fault = 'furniture'").select(F.col(id_col).alias("k"), "line_no")
    cut = out.where("fault = 'hyphen'").select(F.col(id_col).alias("k"), "line_no", F.lit(True).alias("cut"))
    x = lines.join(gone, ["k", "line_no"], "left_anti").join(cut, ["k", "line_no"], "left")
    by = Window.partitionBy("k").orderBy("line_no")
    starts = (F.trim(F.lag("line").over(by)) == "") | F.col("line").rlike(r"^\s{2,}\S")
    x = x.withColumn("paragraph_no", F.sum(F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)).over(by)).where(F.trim("line") != "")
    piece = F.when(F.coalesce(F.col("cut"), F.lit(False)), F.regexp_replace(F.trim("line"), "[-­¬‐]$", "")).otherwise(F.concat(F.trim("line"), F.lit(" ")))
    done = x.withColumn("piece", piece).groupBy("k", "paragraph_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "piece"))).alias("p"))
    done = done.select("k", F.col("paragraph_no").cast("int"), F.trim(F.array_join("p.piece", "")).alias("text"))
    used = seen.where("kind IN ('word', 'cut')").select("k", F.col("key").alias("word")).distinct().join(wrong.select("word", "right"), "word")
    if (better := in_context(docs, near, id_col, text_col, url_col)) is not None:
        used = used.join(better.withColumnRenamed("right", "__better"), ["k", "word"], "left").select("k", "word", F.coalesce("__better", "right").alias("right"))
    fix = used.groupBy("k").agg(F.collect_list(F.struct("word", "right")).alias("fix"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [corrected(t, {r["word"]: r["right"] for r in f}) if f else t for t, f in zip(b.column("text").to_pylist(), b.column("fix").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("paragraph_no"), pa.array(texts, pa.string())], ["k", "paragraph_no", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return done.join(fix, "k", "left").mapInArrow(run, f"k {kind}, paragraph_no int, text string").withColumnRenamed("k", id_col)

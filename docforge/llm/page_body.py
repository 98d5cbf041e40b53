"""Problem 1: the main body of a web page, told from menus, notices, side boxes and footers by a minimum cut.

Each line is a node. A classifier of what the line looks like and of how many pages of its site carry a line like it gives
the capacities to the two terminals, as log odds; it is a logistic regression fitted on a bounded sample of pages that
say themselves what is main and what is beside it (elements and roles), from stated weights that hold where none do; lines next to each other, and lines in one element of the page where
its bytes are kept, are joined by smoothness edges. The maximum flow's cut labels the lines.

How often a line occurs is counted over all pages of the site by a pre-aggregated shuffle of 64-bit keys.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.io import materialise
from docforge.llm import garbled as g
from docforge.llm.arrow import slices
from docforge.llm.scans import paged
from docforge.operators.crawl import content_type
from docforge.operators.timestamps import site_key

#: A line is common if it stands on so many pages of its site, and so large a share of them.
COMMON_PAGES = 3
COMMON_SHARE = 0.05
COMMON_COUNTED = 0.12
#: Capacities of smoothness edges.
NEXT, ITEM_NEXT, HEADED, SAME_ELEMENT, OTHER_ELEMENT = 6, 30, 40, 30, 3

_END = re.compile(r"[.।!?…][\"”»’)]*$")
_DATE = re.compile(r"^\W*(?:\w+,? )?\d{1,2}(?:st|nd|rd|th|er|\.)?\s+(?:de )?[^\W\d]\S*\.?\s+(?:de )?\d{4}\b.{0,24}$|^\W*[^\W\d]+ \d{1,2}, \d{4}\b.{0,24}$|^\W*\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}\b.{0,24}$")
_TABLE = re.compile(r"\d[\d.,]*\s+\d[\d.,]*\s*%?$|\d\s*%$")
_PARTED = re.compile(r"\s[|»>·•›/]\s")


def line_key(line: Column) -> Column:
    """64-bit key of a line's letters in lower case; of its blank-stripped self if there are none."""
    bare = F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}]+", "")
    return F.xxhash64(F.when(bare != "", bare).otherwise(F.trim(line)))


def lead_key(line: Column) -> Column:
    """Key of what stands before the first colon of a line, if that is short and without digits; else null."""
    lead = F.regexp_extract(line, r"^\s*([^:\d]{2,40}?)\s*[:：]", 1)
    return F.when(lead != "", F.xxhash64(F.concat(F.lit("lead:"), F.lower(F.trim(lead)))))


#: What is known of a line's form, and the evidence for boilerplate (above 0) or content (below 0), in tenths of a log odds,
#: that the classifier starts from; where pages say of themselves what is main, it is fitted to that.
KINDS = {"title": -60, "date": -8, "rights": 50, "parted": 50, "table": -30, "common": 40, "common_end": 30, "end": -40, "end_short": -15, "lead": 40, "some": 20}
#: Pages that the classifier is fitted on, at most; those with the smallest hashes of their ids. Strength of the start.
MOST_LABELLED, STRENGTH = 1000, 30.0
#: Bounds of the costs.
MOST_COST = 60


def line_kinds(lines: list[str], title: str | None, pages: list[int], shares: list[float], leads: list[int]) -> list[str | None]:
    """Of each line what is known of its form; None for blank lines and those that tell nothing."""
    out: list[str | None] = []
    name = " ".join((title or "").split())
    for i, raw in enumerate(lines):
        s = " ".join(raw.split())
        if not s:
            out.append(None)
            continue
        ends = _END.search(s) is not None
        counted = any(c.isdigit() for c in s) and not ends  # alike only but for their numbers
        common = pages[i] >= COMMON_PAGES and shares[i] >= (COMMON_COUNTED if counted else COMMON_SHARE)
        kind = None
        if len(name) > 8 and (s == name or name.startswith(s + " |")):
            kind = "title"
        elif _DATE.match(s):
            kind = "date"
        elif "©" in s or "(c)" in s.lower():
            kind = "rights"
        elif _PARTED.search(s) and (common or any(p and p in s for p in (name[:20],)) or not ends):
            kind = "parted"
        elif _TABLE.search(s) and not common:
            kind = "table"
        elif common:
            kind = "common_end" if ends else "common"
        elif ends:
            kind = "end" if len(s) > 40 else "end_short"
        elif leads[i] >= COMMON_PAGES:
            kind = "lead"
        elif pages[i] >= COMMON_PAGES and shares[i] >= COMMON_SHARE / 2 and not counted and s.count(" ") < 3:
            kind = "some"
        out.append(kind)
    return out


def line_features(lines: list[str], kinds: list[str | None], pages: list[int], shares: list[float]) -> np.ndarray:
    """A row for each line: its kind, and how common, long and far down it is, as deviations that are small for most lines."""
    x = np.zeros((len(lines), len(KINDS) + 3))
    place = {k: i for i, k in enumerate(KINDS)}
    for i, (line, kind) in enumerate(zip(lines, kinds)):
        if kind is not None:
            x[i, place[kind]] = 1.0
            x[i, -3:] = min(1.0, shares[i]), math.log1p(len(line.split())) / 4, abs(2 * i / max(1, len(lines) - 1) - 1)
    return x


class LineClassifier:
    """Logistic regression of a line being boilerplate; its log odds, in tenths, are the capacities to the terminals."""

    def __init__(self, weights: np.ndarray | None = None):
        start = np.array([*KINDS.values(), 0, 0, 0], dtype=float) / 10
        self.weights = start if weights is None else weights

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> LineClassifier:
        """The most likely weights of labelled lines, given those that it starts from (Newton's method)."""
        start = cls().weights
        w = start.copy()
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + STRENGTH * (w - start)
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + STRENGTH * np.eye(len(w)), grad)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        return cls(w)

    def costs(self, lines: list[str], title: str | None, pages: list[int], shares: list[float], leads: list[int]) -> list[int]:
        """Of each line, its evidence for boilerplate (above 0) or content (below 0); 0 for lines that tell nothing."""
        kinds = line_kinds(lines, title, pages, shares, leads)
        score = np.clip(np.rint(10 * (line_features(lines, kinds, pages, shares) @ self.weights)), -MOST_COST, MOST_COST).astype(int)
        return [0 if k is None else int(v) or (1 if KINDS[k] > 0 else -1) for k, v in zip(kinds, score)]


def is_item(line: str, score: int) -> bool:
    """Whether a line may be an entry of a list: unfinished, without evidence of its own."""
    return score == 0 and bool(line.strip())


def edges(lines: list[str], score: list[int], element: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(line, line, capacity): each line with the next one that isn't blank, and with the next of its element."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    out = []
    for a, b in zip(full, full[1:]):
        first, second = is_item(lines[a], score[a]), is_item(lines[b], score[b])
        if first and second:
            w = ITEM_NEXT
        elif second and score[a] >= 30 and not _END.search(lines[a].strip()) and not _PARTED.search(lines[a]) and ":" not in lines[a]:
            w = HEADED  # a side box's heading and its entries
        else:
            w = NEXT
        if element is not None and element[a] >= 0 and element[b] >= 0:
            w = max(w, SAME_ELEMENT if (first or second) and max(score[a], score[b]) < 30 else NEXT) if element[a] == element[b] else min(w, OTHER_ELEMENT)
        out.append((a, b, w))
    if element is not None:
        last: dict[int, int] = {}
        for i in full:
            e = element[i]
            if e >= 0:
                if e in last and last[e] != i and not any(a == last[e] and b == i for a, b, _ in out[-1:]):
                    out.append((last[e], i, NEXT))
                last[e] = i
    return out


def cut(score: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """True for the nodes on the boilerplate side of a minimum cut (nodes that could be on either are content)."""
    n = len(score)
    near: list[list[list[int]]] = [[] for _ in range(n)]  # to, residual capacity, place of the way back
    for a, b, w in links:
        near[a].append([b, w, len(near[b])])
        near[b].append([a, w, len(near[a]) - 1])
    give = [max(s, 0) for s in score]  # left from the boilerplate terminal
    take = [max(-s, 0) for s in score]  # left to the content terminal
    while True:
        came: dict[int, tuple[int, list[int]] | None] = {i: None for i in range(n) if give[i]}
        queue = deque(came)
        end = -1
        while queue:
            x = queue.popleft()
            if take[x]:
                end = x
                break
            for e in near[x]:
                if e[1] and e[0] not in came:
                    came[e[0]] = (x, e)
                    queue.append(e[0])
        if end < 0:
            return [i in came for i in range(n)]
        path, x = [], end
        while came[x] is not None:
            x, e = came[x]
            path.append(e)
        flow = min([give[x], take[end], *(e[1] for e in path)])
        give[x] -= flow
        take[end] -= flow
        for e in path:
            e[1] -= flow
            near[e[0]][e[2]][1] += flow


class Elements(HTMLParser):
    """The pieces of text of a page with the number of the element that holds their block."""

    BREAKS = frozenset("div p li h1 h2 h3 h4 td th tr table br ul ol section main article nav aside header footer body center blockquote form dl dt dd".split())
    HOLDERS = frozenset("div td section main article nav aside header footer center blockquote ul ol table form".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int]] = []
        self.text: list[str] = []
        self.open: list[tuple[str, int]] = []
        self.count = 0
        self.mute = 0
        self.single: dict[int, int] = {}

    def _flush(self) -> None:
        s = " ".join("".join(self.text).split())
        self.text = []
        if s:
            inner = self.open[-1][1] if self.open else 0
            outer = self.open[-2][1] if len(self.open) > 1 else 0
            self.found.append((s, inner if self.single.get(inner, 0) > 0 else outer or inner))
            self.single[inner] = self.single.get(inner, 0) + 1

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.mute += 1
        if tag in self.BREAKS:
            self._flush()
        if tag in ("td", "tr"):
            while self.open and self.open[-1][0] == "td":
                self.open.pop()
        if tag in self.HOLDERS:
            self.count += 1
            self.open.append((tag, self.count))

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.mute = max(0, self.mute - 1)
        if tag in self.BREAKS:
            self._flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if not self.mute:
            self.text.append(data)


class Page(Elements):
    """A whole page: its title apart from its lines."""

    def __init__(self):
        super().__init__()
        self.title = ""
        self.named = False

    def handle_starttag(self, tag, attrs):
        self.named = tag == "title" and not self.title
        if self.named:
            self._flush()
        super().handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.named = False
        super().handle_endtag(tag)

    def handle_data(self, data):
        if self.named:
            self.title += data
        else:
            super().handle_data(data)


def page_text(headers, data: bytes) -> tuple[str | None, str]:
    """A fetched page's title, without the site's name behind a bar, and its lines."""
    text, fine = g.decoded(headers, data)
    if not fine or "\0" in text or g.garbled([text])[0]:
        text = g.original(headers, data)
    page = Page()
    page.feed(text)
    page.close()
    page._flush()
    return " ".join(page.title.split()).split(" | ")[0] or None, "\n".join(x for x, _ in page.found)


def elements(lines: list[str], headers, data: bytes | None) -> list[int] | None:
    """For each line the element it stands in, -1 if it isn't found; None without bytes."""
    if not data:
        return None
    page = Elements()
    page.feed(g.decoded(headers, data)[0])
    page.close()
    page._flush()
    where: dict[str, list[int]] = {}
    for s, e in page.found:
        where.setdefault(s, []).append(e)
    out = []
    for x in lines:
        hit = where.get(" ".join(x.split()))
        out.append((hit.pop(0) if len(hit) > 1 else hit[0]) if hit else -1)
    return out


class Zones(Elements):
    """The pieces of text of a page with what the page itself says of them: False in its main part, True in parts beside it, else None."""

    MAIN = frozenset("main article".split())
    BESIDE = frozenset("nav aside footer banner navigation complementary contentinfo search".split())
    VOID = frozenset("br hr img input link meta area base col embed source track wbr p li td tr th dt dd option".split())

    def __init__(self):
        super().__init__()
        self.zones: list[tuple[str, bool | None]] = []

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if tag not in self.VOID:
            said = {tag, dict(attrs).get("role") or ""}
            outer = self.zones[-1][1] if self.zones else None
            self.zones.append((tag, True if said & self.BESIDE else False if said & self.MAIN else outer))

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        for i in range(len(self.zones) - 1, -1, -1):
            if self.zones[i][0] == tag:
                del self.zones[i:]
                break

    def _flush(self) -> None:
        before = len(self.found)
        super()._flush()
        if len(self.found) > before:
            self.found[-1] = (self.found[-1][0], self.zones[-1][1] if self.zones else None)


def zone_labels(lines: list[str], headers, data: bytes) -> list[bool | None]:
    """For each line what its page says of it; None where it says nothing, or two things of the same line."""
    page = Zones()
    page.feed(g.decoded(headers, data)[0])
    page.close()
    page._flush()
    said: dict[str, set] = {}
    for s, zone in page.found:
        said.setdefault(s, set()).add(zone)
    one = lambda x: next(iter(x)) if len(x) == 1 else None
    return [one(said.get(" ".join(x.split()), {None})) for x in lines]


def fitted(ready: DataFrame) -> LineClassifier:
    """The classifier fitted on the lines of pages (k, title, t, n, pages, leads, headers, data) that say what is main.

    All lines beside the main part are labelled. Sites put share prompts and the like inside it, too, so a line there is
    labelled content only if it is not of a kind that repeats over pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows, labels = [], []
            for r in part.to_pylist():
                lines, shares = r["t"].split("\n"), [x / max(r["n"], 1) for x in r["pages"]]
                kinds = line_kinds(lines, r["title"], r["pages"], shares, r["leads"])
                x = line_features(lines, kinds, r["pages"], shares)
                for i, zone in enumerate(zone_labels(lines, r["headers"], r["data"])):
                    if kinds[i] is not None and zone is not None and (zone or KINDS[kinds[i]] < 0):
                        rows.append(x[i].tolist())
                        labels.append(zone)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.bool_())], ["x", "y"])

    found = ready.mapInArrow(run, "x array<double>, y boolean").collect()
    if not found:
        return LineClassifier()
    return LineClassifier.fit(np.array([r[0] for r in found]), np.array([r[1] for r in found], dtype=float))


def label(text: str, title: str | None, pages: list[int], shares: list[float], leads: list[int], headers=None, data: bytes | None = None, model: LineClassifier | None = None) -> list[bool]:
    """For each line whether it is boilerplate; blank lines aren't."""
    lines = text.split("\n")
    score = (model or LineClassifier()).costs(lines, title, pages, shares, leads)
    side = cut(score, edges(lines, score, elements(lines, headers, data)))
    return [s and bool(x.strip()) for s, x in zip(side, lines)]


def raw_doc_id(url: Column, fetched_at: Column) -> Column:
    """The id of the document parsed from a fetched page."""
    at = F.date_format(F.to_utc_timestamp(fetched_at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    return F.substring(F.sha2(F.concat(url, F.lit("|"), at, F.lit("+00:00")), 256), 1, 16)


def line_counts(pages: DataFrame) -> DataFrame:
    """(k, n, alike): for each page the number of pages of its site, and a map from key to pages for its lines that others of
    the site have, too, and for its leads that pages of any site have.

    ``pages`` has k, site, keys, leads and counted, each page once; those that aren't counted are compared with the others.
    """
    own = pages.select("k", "site", "counted", F.explode(F.array_distinct(F.array_compact("keys"))).alias("key"))
    lead = pages.select("k", F.lit("*").alias("site"), "counted", F.explode(F.array_distinct(F.array_compact("leads"))).alias("key"))  # alike on all sites
    each = own.unionByName(lead)
    many = each.where("counted").groupBy("site", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= COMMON_PAGES)
    sizes = pages.where("counted").groupBy("site").agg(F.count("*").alias("n"))
    alike = each.join(many, ["site", "key"]).groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("key", "pages"))).alias("alike"))
    return pages.join(sizes, "site", "left").join(alike, "k", "left").select("k", F.coalesce("n", F.lit(1)).alias("n"), "alike", "keys", "leads")


def boilerplate_lines(parsed: DataFrame, raw: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "body_text", title_col: str = "title", url_col: str = "url", beside: DataFrame | None = None) -> DataFrame:
    """(id, line_no) of the lines of pages fetched as HTML that aren't part of the main body.

    ``raw`` are fetched pages; where one's bytes are kept, its elements give the proximity edges. Lines
    are what lies between ``\n``, from 1; blank ones are no case. Null and blank texts have none; a page
    delivered twice counts once; other columns are left out; an empty table gives an empty result. Pages of
    ``beside`` are counted with them; rows with a false column ``counted`` are not.
    """

    def picked(df: DataFrame) -> DataFrame:
        x = df.where(~F.coalesce(paged(F.col(url_col)), F.lit(False)) & F.col(text_col).rlike(r"\S") & F.col(id_col).isNotNull())
        counted = F.col("counted") if "counted" in df.columns else F.lit(True)
        return x.select(F.col(id_col).alias("k"), F.coalesce(site_key(F.col(url_col)), F.lit("")).alias("site"), F.col(title_col).alias("title"), F.col(text_col).alias("t"), counted.alias("counted"))

    pages = picked(parsed)
    counted = pages if beside is None else pages.unionByName(picked(beside))
    lines = F.split("t", "\n", -1)
    key = F.transform(lines, lambda x: F.when(F.trim(x) != "", line_key(x)))
    slim = counted.select("k", "site", "counted", key.alias("keys"), F.transform(lines, lead_key).alias("leads")).groupBy("k").agg(F.first("site").alias("site"), F.first("counted").alias("counted"), F.first("keys").alias("keys"), F.first("leads").alias("leads"))
    known = materialise(line_counts(materialise(slim, "keys")), "counts")
    whole = pages.select("k", "title", "t").dropDuplicates(["k"]).join(known, "k")
    if raw is not None:
        kept = raw.where((F.col("http_status") == 200) & (F.length("content_bytes") > 0)).select(raw_doc_id(F.col("url"), F.col("fetched_at")).alias("k"), "headers", F.col("content_bytes").alias("data")).dropDuplicates(["k"])
        whole = whole.join(kept, "k", "left")
    else:
        whole = whole.withColumns({"headers": F.lit(None).cast("map<string,string>"), "data": F.lit(None).cast("binary")})
    counts = lambda keys: F.transform(keys, lambda x: F.coalesce(F.when(x.isNotNull(), F.try_element_at("alike", x)), F.lit(0)).cast("int"))
    ready = whole.select("k", "title", "t", "n", counts(F.col("keys")).alias("pages"), counts(F.col("leads")).alias("leads"), "headers", "data")

    model = LineClassifier()
    if raw is not None:
        says = kept.where(F.col("data").cast("string").rlike(r"(?i)<(main|article)[\s>]|role\s*=\s*[\"']?main")).select("k").join(pages.select("k").distinct(), "k", "left_semi")
        edge = says.select(F.xxhash64("k").alias("h")).orderBy("h").limit(MOST_LABELLED).agg(F.max("h")).first()[0]
        if edge is not None:
            few = F.xxhash64("k") <= edge
            own = pages.where(few).select("k", "title", "t").dropDuplicates(["k"]).join(known.where(few), "k").join(kept.where(few).join(says.where(few), "k", "left_semi"), "k")
            model = fitted(own.select("k", "title", "t", "n", counts(F.col("keys")).alias("pages"), counts(F.col("leads")).alias("leads"), "headers", "data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            ids, at = [], []
            for r in part.to_pylist():
                n = max(r["n"], 1)
                side = label(r["t"], r["title"], r["pages"], [x / n for x in r["pages"]], r["leads"], r["headers"], r["data"], model)
                hits = [i + 1 for i, s in enumerate(side) if s]
                ids += [r["k"]] * len(hits)
                at += hits
            yield pa.RecordBatch.from_arrays([pa.array(ids, part.schema.field("k").type), pa.array(at, pa.int32())], ["k", "line_no"])

    kind = parsed.schema[id_col].dataType.simpleString()
    return ready.mapInArrow(run, f"k {kind}, line_no int").withColumnRenamed("k", id_col)


def unparsed_pages(parsed: DataFrame, raw: DataFrame, id_col: str = "doc_id", text_col: str = "body_text") -> DataFrame:
    """(id, url, title, text, counted) of the HTML pages fetched that have no parsed row, each once, from their bytes.

    Counted is the latest fetch of each URL that no parsed page has, so that a page fetched again is not common by that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            read = [page_text(head, data) for head, data in zip(part.column("headers").to_pylist(), part.column("data").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("k"), part.column("url"), part.column("fetched_at"), pa.array([t for t, _ in read], pa.string()), pa.array([x for _, x in read], pa.string())], ["k", "url", "fetched_at", "title", "t"])

    ok = raw.where((F.col("http_status") == 200) & (F.length("content_bytes") > 0) & ~F.coalesce(paged(F.col("url")), F.lit(False)) & (content_type(F.col("headers"), F.col("content_bytes")) != "pdf"))
    new = ok.select(raw_doc_id(F.col("url"), F.col("fetched_at")).alias("k"), "url", F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("fetched_at"), "headers", F.col("content_bytes").alias("data"))
    new = new.join(parsed.select(F.col(id_col).alias("k")), "k", "left_anti").dropDuplicates(["k"])
    pages = materialise(new.mapInArrow(run, "k string, url string, fetched_at bigint, title string, t string"), "unparsed")
    latest = pages.groupBy("url").agg(F.max_by("k", "fetched_at").alias("k")).join(parsed.select("url"), "url", "left_anti").select("k", F.lit(True).alias("counted"))
    return pages.join(latest, "k", "left").select(F.col("k").alias(id_col), "url", "title", F.col("t").alias(text_col), F.coalesce("counted", F.lit(False)).alias("counted"))


def main_bodies(parsed: DataFrame, raw: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "body_text") -> DataFrame:
    """(id, text): each HTML page's text without the lines found; of pages fetched and not parsed yet, by the id that they will have."""

    def bodies(df: DataFrame, found: DataFrame) -> DataFrame:
        drop = found.groupBy(id_col).agg(F.collect_set("line_no").alias("__drop"))
        pages = df.where(~F.coalesce(paged(F.col("url")), F.lit(False))).select(id_col, text_col).dropDuplicates([id_col])
        kept = F.filter(F.split(text_col, "\n", -1), lambda x, i: ~F.coalesce(F.array_contains("__drop", i + 1), F.lit(False)))
        return pages.join(drop, id_col, "left").select(id_col, F.array_join(kept, "\n").alias(text_col))

    out = bodies(parsed, boilerplate_lines(parsed, raw, id_col, text_col))
    if raw is None:
        return out
    new = unparsed_pages(parsed, raw, id_col, text_col)
    return out.unionByName(bodies(new, boilerplate_lines(new, raw, id_col, text_col, beside=parsed)))

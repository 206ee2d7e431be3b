"""Main text of web pages by a maximum-scoring subsequence.

A page is read once into a sequence of tags and text runs.  A run scores its
number of words times the weight of the element around it, positive where that
element holds content in the labelled pages; every tag scores below zero, the
more so the more often it stands outside the content there.  Where a page marks
an ``article`` or ``main`` itself, elements inside and outside of it are kinds of
their own.  One linear scan finds the contiguous stretch with the highest sum.
Elements that are never main text (menus, adverts, forms, comments and the like)
are left out of the result wherever they stand, so they cost next to nothing and
do not cut a stretch in two.  What remains is returned block by block.

Labelled pages are those that mark their own content with a single ``article``
or ``main`` element.  Every such page is counted, in the tasks, and no count is
dropped.  The weights of the most frequent kinds of element, ``KINDS`` at most, are
sent to the tasks, and as many of bare tags and one of all elements, each over all of
its kinds: a kind that is not sent has its tag's weight, or that of all elements.
Without labelled pages the weights are those of the priors below.

Defined results: NULL, empty and text-free pages give an empty text; broken
markup never fails (an unclosed script, style, title, textarea, noscript, iframe or
comment runs to the end; of other unclosed elements only the tag goes); pages of any
length and however broken are read in time linear in their length; repeated
rows are read alike; of stretches with equal sums the first and longest is
taken; a NULL id stays NULL; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.llm.common import ship_code
from sievemart.session import cut_lineage

KINDS = 4096

# Roles of elements in the public HTML vocabulary.
RAW = "script style noscript iframe title textarea".split()
DROPPED = "template object svg canvas".split()  # with what they hold, if they are closed
VOID = "area base br col embed hr img input link meta param source track wbr".split()
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt"
    " math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup munder mover munderover mstyle semantics"
    " ruby s samp small span strike strong sub sup time tt u var wbr"
).split()
NEVER = (
    "head nav menu aside footer header form button select option fieldset dialog audio video map"
).split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
CONTENT = ["p", "blockquote", "pre", "article", "main", "figcaption", "td", "dd", *HEADINGS]
NEVER_CLASS = frozenset(
    "ad ads advert adverts advertisement adbox sponsor sponsored promo promotion banner nav navbar"
    " navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments reply replies"
    " disqus notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe share"
    " sharing social related recommended widget form search login toolbar copyright legal disclaimer"
    " alert".split()
)
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
HOLDERS = frozenset(("html", "body", "article", "main"))

# Most tags: no "<" or ">" in an attribute, so a failed try reads no further than the next tag.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
RAW_START = re.compile(rf"({'|'.join(RAW)})(?=[\s/>])", re.IGNORECASE)
RAW_END = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in RAW}
DROPPED_TAG = {name: re.compile(rf"<(/?){name}(?=[\s/>])", re.IGNORECASE) for name in DROPPED}
QUOTED = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[a-z0-9]+")

OUTSIDE_COST = 4.0
TAG_OUTSIDE_COST = 1.0
TAG_COST = 0.01
SKIPPED_COST = 0.001
INSIDE, OUTSIDE = "inside", "outside"


class Markup:
    """Finds the tags of a page, each place of it being read a bounded number of times.

    Whatever is not found from one place on is not looked for again from a later one.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.end = html.find(">")  # the place of the ">" found last, -1 if there is no further one
        self.stops: list[int] | None = None
        self.ends: list[int] = []

    def first_end(self, at: int) -> int:
        """The place behind the next ``>``, -1 if there is none."""
        if 0 <= self.end < at:
            self.end = self.html.find(">", at)
        return self.end + 1 if self.end >= 0 else -1

    def quoted_end(self, at: int) -> int:
        """The place behind the next ``>`` outside of quotes, -1 if there is none.

        After the first tag whose quotes stay open, the ends from all quotes and
        ``>`` on are worked out at once, from the last one backwards.
        """
        if self.stops is None:
            if found := QUOTED.match(self.html, at):
                return found.end()
            self._work_out_ends()
        stop = bisect_left(self.stops, at)
        return self.ends[stop] if stop < len(self.stops) else -1

    def _work_out_ends(self) -> None:
        self.stops = [m.start() for m in STOP.finditer(self.html)]
        self.ends = [-1] * (len(self.stops) + 1)
        following: dict[str, int] = {}  # the next quote of each sort
        for number in range(len(self.stops) - 1, -1, -1):
            sort = self.html[self.stops[number]]
            if sort == ">":
                self.ends[number] = self.stops[number] + 1
            else:
                if sort in following:
                    self.ends[number] = self.ends[following[sort] + 1]
                following[sort] = number

    def token(self, at: int) -> Token | None:
        """The first tag, comment, raw element or declaration from ``at`` on."""
        html = self.html
        while (start := html.find("<", at)) >= 0:
            if (plain := PLAIN_TAG.match(html, start)) and (name := plain[2].lower()) not in RAW_END:
                return Token(start, plain.end(), name, bool(plain[1]), plain[3])
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                return Token(start, end + 3 if end >= 0 else len(html))
            if (first := self.first_end(start)) < 0:
                at = html.find("<!--", start)
                if at < 0:
                    return None
                continue
            if html[start + 1] in "!?":
                return Token(start, first)
            if raw := RAW_START.match(html, start + 1):
                end = RAW_END[raw[1].lower()].search(html, first)
                return Token(start, end.end() if end else len(html), raw=True)
            if name := NAME.match(html, start + 1):
                end = self.quoted_end(name.end())
                end = first if end < 0 else end
                closes = html[start + 1] == "/"
                return Token(start, end, name[1].lower(), closes, html[name.end() : end - 1])
            at = start + 1
        return None

    def closed(self, name: str) -> dict[int, int]:
        """Of each closed element of that name: where its start tag begins and its end tag ends."""
        ends, open_, at = {}, [], 0
        while found := DROPPED_TAG[name].search(self.html, at):
            at = self.quoted_end(found.end())
            if at < 0:
                at = found.end()
            elif not found[1]:
                if not (name == "svg" and self.html[at - 2] == "/"):
                    open_.append(found.start())
            elif open_:
                ends[open_.pop()] = at
        return ends


class Token(NamedTuple):
    """What lies between two texts; ``name`` is empty unless it is a tag."""

    start: int
    end: int
    name: str = ""
    closes: bool = False
    attrs: str = ""
    raw: bool = False


class Run:
    """A stretch of text, or a tag (``text`` is None)."""

    __slots__ = ("kind", "text", "skipped", "labelled", "block")

    def __init__(self, kind: str, text: str | None, skipped: bool, labelled: bool, block: int) -> None:
        self.kind, self.text, self.skipped, self.labelled, self.block = kind, text, skipped, labelled, block


def _kind(name: str, attrs: str) -> tuple[str, int]:
    """The element's kind, by name and classes, and whether it is never main text.

    That is 2 by its tag or role, and 1 by a class or id of which every part says so:
    ``cookie-notice``, but not ``has-sidebar``.
    """
    never = 2 if name in NEVER else 0
    kind = name
    if attrs and name not in HOLDERS:
        for key, *values in ATTRIBUTE.findall(attrs):
            key, value = key.lower(), "".join(values).lower()
            if key == "role":
                never = never if NEVER_ROLE.isdisjoint(value.split()) else 2
            elif key in ("class", "id"):
                parts = [NAME_PART.findall(x) for x in value.split()]
                if any(x and NEVER_CLASS.issuperset(x) for x in parts):
                    never = never or 1
                if key == "class" and (flat := [y for x in parts for y in x]):
                    kind = f"{name}.{'.'.join(flat[:2])}"
    return kind, never


def read_runs(html: str) -> tuple[list[Run], int]:
    """The page as tags and text runs, and how many ``article``/``main`` it has."""
    runs: list[Run] = []
    open_: list[tuple[str, str, int]] = []  # name, kind, whether inside what is never main text
    block = articles = holders = 0
    at = 0
    closed: dict[str, dict[int, int]] = {}
    named: Counter[str] = Counter()  # open elements by name
    markup = Markup(html)

    def push(name: str, kind: str, skipped: int) -> None:
        open_.append((name, kind, skipped))
        named[name] += 1

    def pop() -> str:
        name = open_.pop()[0]
        named[name] -= 1
        return name

    def text_run(raw: str) -> None:
        kind, skipped = (open_[-1][1], open_[-1][2]) if open_ else ("", 0)
        runs.append(Run(kind, unescape(raw), skipped, holders > 0, block))

    while found := markup.token(at):
        if found.start > at:
            text_run(html[at : found.start])
        at = found.end
        name, closes = found.name, found.closes
        if not name:  # comments, raw elements, declarations
            block += found.raw
            continue
        if name in DROPPED:
            if not closes:
                if name not in closed:
                    closed[name] = markup.closed(name)
                at = closed[name].get(found.start, at)
            block += 1
            continue
        if name in INLINE and name != "label":
            kind, skipped = (open_[-1][1], open_[-1][2]) if open_ else ("", 0)
            runs.append(Run(name, None, skipped, holders > 0, block))
            if name == "br":
                runs.append(Run(kind, " ", skipped, holders > 0, block))
            elif not closes:
                own, never = _kind(name, found.attrs)
                if never:
                    push(name, own, max(skipped, never))
            elif open_ and open_[-1][0] == name:
                pop()
            continue
        block += 1
        if closes:
            last = "" if named[name] else name  # an end tag of nothing open closes nothing
            while last != name:
                last = pop()
                holders -= last in ("article", "main")
            runs.append(Run(name, None, open_[-1][2] if open_ else False, holders > 0, block))
            continue
        kind, never = _kind(name, found.attrs)
        while open_ and (open_[-1][0] == "p" or open_[-1][0] == name == "li" or open_[-1][0] in HEADINGS and name in HEADINGS):
            pop()
        within = open_[-1][2] if open_ else 0
        if name in HEADINGS and within and holders and open_[-1][0] == "header":
            within = 0  # an article's own header holds its heading
        if name in ("article", "main"):
            if within == 1 and not holders:
                within = 0  # a class of the wrapper says less than the page's own mark
            articles += not holders
            holders += 1
        runs.append(Run(kind, None, max(within, never), holders > 0, block))
        if name not in VOID:
            push(name, kind, max(within, never))
    if at < len(html):
        text_run(html[at:])
    return runs, articles


def _kind_of(run: Run, marked: bool) -> str:
    """What a run is weighed as; ``marked`` if the page marks its content itself."""
    side = f" {INSIDE if run.labelled else OUTSIDE}" if marked else ""
    return f"{run.kind}{side}" if run.text is None else f"words {run.kind}{side}"


def _flushed(seen: Counter[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "kind": pa.array([k for k, _ in seen], pa.string()),
            "side": pa.array([s for _, s in seen], pa.string()),
            "seen": pa.array(list(seen.values()), pa.int64()),
        }
    )


def _broader(kind: str) -> list[str]:
    """What stands for a kind without a weight of its own: its tag, then all elements."""
    words = "words " if kind.startswith("words ") else ""
    name, space, side = kind.removeprefix("words ").partition(" ")
    return [f"{words}{x}{space}{side}" for x in (f"{name.partition('.')[0]}.*", "*")]


def _count_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and tags of each kind inside and outside the content of labelled pages."""
    seen: Counter[tuple[str, str]] = Counter()
    for batch in batches:
        for html in batch.column(0).to_pylist():
            runs, articles = read_runs(html or "")
            if articles != 1:
                continue
            for run in runs:
                if run.skipped:
                    continue
                side = INSIDE if run.labelled else OUTSIDE
                count = 1 if run.text is None else len(run.text.split())
                for marked in (False, True):
                    seen[_kind_of(run, marked), side] += count
        if len(seen) > 16 * KINDS:
            yield _flushed(seen)
            seen.clear()
    yield _flushed(seen)


def learn_weights(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weight per kind of word and tag, from all labelled pages."""
    ship_code(pages.sparkSession)
    counts = pages.select(F.col(html_col).alias("html")).mapInArrow(
        _count_kinds, "kind string, side string, seen long"
    )
    # A kind is "[words ]tag[.class[.class]][ side]"; its tag and all elements stand beside it.
    named = r"^(words )?([^ .]*)(\.[^ ]*)?"
    per_kind = counts.groupBy("kind").agg(
        F.sum(F.when(F.col("side") == INSIDE, F.col("seen"))).alias(INSIDE),
        F.sum(F.when(F.col("side") == OUTSIDE, F.col("seen"))).alias(OUTSIDE),
    )
    per_kind = cut_lineage(per_kind)
    found = []
    for kind in (F.col("kind"), F.regexp_replace("kind", named, "$1$2.*"), F.regexp_replace("kind", named, "$1*")):
        summed = per_kind.groupBy(kind.alias("kind")).agg(F.sum(INSIDE).alias(INSIDE), F.sum(OUTSIDE).alias(OUTSIDE))
        total = F.coalesce(INSIDE, F.lit(0)) + F.coalesce(OUTSIDE, F.lit(0))
        found += summed.orderBy(total.desc(), "kind").limit(KINDS).collect()
    return {r["kind"]: _weight(r["kind"], r[INSIDE] or 0, r[OUTSIDE] or 0) for r in found}


def _weight(kind: str, inside: float, outside: float) -> float:
    words = kind.startswith("words ")
    name, _, side = kind.removeprefix("words ").partition(" ")
    # Priors, as counts seen beforehand.
    inside += 8.0 if name.partition(".")[0] in CONTENT or side == INSIDE else 2.0
    outside += 16.0 if side == OUTSIDE else 0.3
    out = outside / (inside + outside)
    return 1.0 - out - OUTSIDE_COST * out if words else -TAG_COST - TAG_OUTSIDE_COST * out


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the highest sum, (0, 0) if none is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, at
        total += score
        if total > best or total == best > 0 and start == span[0]:
            best, span = total, (start, at + 1)
    return span


def main_text(html: str, weights: dict[str, float]) -> str:
    runs, articles = read_runs(html)
    scores = []
    for run in runs:
        size = 1 if run.text is None else len(run.text.split())
        if run.skipped:
            scores.append(-SKIPPED_COST * size)
            continue
        kind = _kind_of(run, articles > 0)
        if kind not in weights:
            known = next((weights[k] for k in _broader(kind) if k in weights), None)
            weights[kind] = _weight(kind, 0, 0) if known is None else known
        scores.append(size * weights[kind])
    start, end = best_stretch(scores)
    blocks: dict[int, list[str]] = {}
    for run in runs[start:end]:
        if run.text is not None and not run.skipped:
            blocks.setdefault(run.block, []).append(run.text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Per row: id, URL, main text and its length in characters."""
    ship_code(pages.sparkSession)
    weights = learn_weights(pages, html_col) if weights is None else weights

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(weights)
        for batch in batches:
            texts = []
            for html in batch.column("html").to_pylist():
                texts.append(main_text(html or "", known))
                if len(known) > 4 * KINDS:
                    known = dict(weights)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInArrow(extract, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")

"""Main text of web pages as the maximum-scoring run of their tokens.

A page is a row of tokens: tags and stretches of text. Words score positive and tags negative,
each by its kind: a word by the block element around it and whether it is linked, a tag by
its name. One linear scan finds the run with the largest sum, and the text blocks in it are
the main text. Elements that are furniture by their name or class (menus, adverts, notices,
forms, comments and the like) are one kind of their own, score against the run, and never
enter the text. A class counts as a whole, or if all its parts are such words or tell a place
(``site-nav``, not ``has-sidebar``). The page, its body and its articles are never furniture, nor is
what holds the body, the main element, the page's only articles, or (forms) most of its words.

Weights are logarithmic odds learnt from labelled pages, those that mark their article
themselves, over at most ``sample`` pages (smallest hashes of page_id). Kinds that no labelled
page shows keep their prior.

Defined cases: null and empty pages have empty text, as has a page without a word; a cut-off page
ends its open elements; an unfinished tag at the end is dropped; repeated rows are treated alike;
an empty table gives no rows and prior weights; further columns are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2_000
WORD_PRIOR, TAG_PRIOR = 0.5, -0.3
LEAST, MOST = 0.05, 2.0
FURNITURE_WORD, FURNITURE_TAG = -0.2, -0.1

TOKEN = re.compile(
    r"(?P<comment><!--(?:.*?-->|.*\Z))"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?P<close>>|\Z)"
    r"|(?P<other><[!?/][^>]*(?:>|\Z))"
    r"|(?P<text><?[^<]*)",
    re.DOTALL,
)
CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s\"'>]+))", re.IGNORECASE)
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "xmp"}

#: Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter object output picture progress q rp rt ruby s samp slot small span strike strong "
                   "sub sup time tt u var".split())
#: Elements that hold no main text.
FURNITURE = frozenset("aside button dialog fieldset footer form head iframe menu nav noscript script select style svg template textarea title".split())
#: Words in class, id or role that mark furniture.
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promotion recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: Words that make a header one of the text.
TEXT_NAMES = frozenset("article content entry post story".split())
#: Parts of a class that only tell a place or a shape.
PLACES = frozenset("area bar bottom box center container global inner left link links list main outer page panel primary right secondary section site sticky top wrap wrapper".split())
#: Elements that are never furniture.
NEVER_FURNITURE = frozenset("html body main article".split())
ENDED_BY_SIBLING = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}


@dataclass
class Token:
    kind: str
    text: str = ""
    words: int = 0
    breaks: bool = False
    furniture: bool = False
    labelled: bool = False


def tokens(page: str) -> list[Token]:
    """Tags and texts in page order, each with its kind."""
    holders = _Holders()
    row = list(_tokens(page, frozenset(), holders))
    spared = holders.spared()
    return list(_tokens(page, spared, None)) if spared else row


def _known(name: str) -> str:
    """Element names beyond the fixed lists are one kind, so kinds are bounded whatever a page invents."""
    return name if name in BLOCKS or name in INLINE or name in VOID or name in FURNITURE else "other"


@dataclass
class _Holders:
    """Furniture, by where it begins, that holds the page itself rather than parts of it."""

    always: set[int] = field(default_factory=set)  # holds the body or the main element
    articles: set[int] = field(default_factory=set)  # holds an article
    free_article: bool = False  # an article stands outside all furniture
    words: int = 0  # outside furniture other than forms
    by_form: dict[int, int] = field(default_factory=dict)

    def spared(self) -> frozenset[int]:
        forms = {at for at, n in self.by_form.items() if 2 * n > self.words}
        return frozenset(self.always | forms | (set() if self.free_article else self.articles))


def _tokens(page: str, spared: frozenset[int], holders: _Holders | None) -> Iterator[Token]:
    stack: list[tuple[str, bool]] = []  # block elements that are open, and whether they are furniture
    places: list[tuple[int, bool, int]] = []  # where the furniture among them begins, whether it is a form, and the holders' words before it
    open_names: Counter = Counter()
    hidden, strict, linked, article, at = 0, 0, 0, 0, 0  # strict: open furniture other than forms
    length = len(page)

    def leave(depth: int) -> None:
        """Ends the furniture from ``depth`` on."""
        nonlocal strict
        for where, form, before in places[depth:]:
            strict -= not form
            if holders and form:
                holders.by_form[where] = holders.words - before
        del places[depth:]

    def note(found: set[int]) -> None:
        """Enters all open furniture; what lies around a noted one was noted with it."""
        for where, _, _ in reversed(places):
            if where in found:
                break
            found.add(where)

    def close(begin: int) -> tuple[int, int]:
        """Ends the elements from ``begin`` on; how many of them were furniture and articles."""
        gone = stack[begin:]
        del stack[begin:]
        open_names.subtract(n for n, _ in gone)
        leave(len(places) - sum(f for _, f in gone))
        return sum(f for _, f in gone), sum(n in ("article", "main") for n, _ in gone)

    while at < length:
        m = TOKEN.match(page, at)
        at = max(m.end(), at + 1)
        if m["comment"] is not None or m["other"] is not None:
            continue
        if m["text"] is not None:
            words = len(m["text"].split())
            where = stack[-1][0] if stack else "body"
            if holders and not strict:
                holders.words += words
            kind = "furniture word" if hidden else f"word in {_known(where)}" + " link" * bool(linked)
            yield Token(kind, m["text"], words, furniture=hidden > 0, labelled=article > 0 and not hidden)
            continue
        name = m["name"].lower()
        if m["end"]:
            if name == "a":
                linked = 0
            token = Token("furniture tag" if hidden else f"tag {_known(name)}", breaks=name in BLOCKS, furniture=hidden > 0, labelled=article > 0 and not hidden)
            if open_names[name] > 0:
                furniture, articles = close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
                hidden, article, linked = hidden - furniture, article - articles, 0
            yield token
            continue
        if not m["close"]:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else length
            yield Token("furniture tag", furniture=True)
            continue
        if name in BLOCKS:
            for i in range(len(stack) - 1, -1, -1):
                if name in ENDED_BY_SIBLING.get(stack[i][0], ()):
                    hidden, linked = hidden - close(i)[0], 0
                elif stack[i][0] not in ENDED_BY_SIBLING:
                    break
        named = _furniture_class(m["rest"])
        furniture = name not in NEVER_FURNITURE and (name in FURNITURE or (name == "header" and not article) or named)
        own, furniture = furniture, furniture and m.start() not in spared
        if holders and name in NEVER_FURNITURE:
            if name == "article" and not named:
                holders.free_article |= not hidden
                note(holders.articles)
            elif name != "article":
                holders.free_article |= name == "main" and not hidden
                note(holders.always)
        if name == "a":
            linked = 1
        if name not in VOID and (name in BLOCKS or own):
            if furniture:
                form = name == "form" and not named
                places.append((m.start(), form, holders.words if holders else 0))
                strict += not form
            stack.append((name, furniture))
            open_names[name] += 1
            hidden += furniture
            article += name in ("article", "main")
        yield Token("furniture tag" if hidden else f"tag {_known(name)}", breaks=name in BLOCKS, furniture=hidden > 0, labelled=article > 0 and not hidden)
    leave(0)


def _furniture_class(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    for m in CLASS.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = {p for p in re.split(r"[_-]+", name) if p} - PLACES
            if parts and parts <= FURNITURE_NAMES | {"header"}:
                if parts != {"header"} or not TEXT_NAMES & set(re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower())):
                    return True
    return False


@dataclass
class Weights:
    by_kind: dict[str, float] = field(default_factory=dict)

    def of(self, token: Token) -> float:
        if token.furniture:
            return FURNITURE_WORD * token.words if token.words else FURNITURE_TAG
        if token.kind.startswith("word"):
            return token.words * self.by_kind.get(token.kind, WORD_PRIOR)
        return self.by_kind.get(token.kind, TAG_PRIOR)


def kind_counts(page: str) -> Counter:
    """How often each kind occurs inside and outside the article a page marks; nothing if it marks none."""
    counts: Counter = Counter()
    marked = False
    for t in tokens(page):
        marked |= t.labelled
        if not t.furniture:
            counts[t.kind, t.labelled] += max(t.words, 1) if t.kind.startswith("word") else 1
    return counts if marked else Counter()


def learnt(counts: dict[tuple[str, bool], int]) -> Weights:
    """Words keep a positive and tags a negative weight, whose size follows the odds."""
    inside = sum(n for (_, i), n in counts.items() if i) + 1
    outside = sum(n for (_, i), n in counts.items() if not i) + 1
    out = {}
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / inside) - math.log((counts.get((kind, False), 0) + 1) / outside)
        if kind.startswith("word"):
            out[kind] = min(MOST, max(LEAST, WORD_PRIOR + odds / 4))
        else:
            out[kind] = max(-MOST, min(-LEAST, TAG_PRIOR + odds / 4))
    return Weights(out)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the run with the largest sum; of equal ones the first; empty without a positive score."""
    best, run, begin, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, begin = 0.0, i
        run += s
        if run > best:
            best, found = run, (begin, i + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    row = list(tokens(page))
    begin, end = best_run([weights.of(t) for t in row])
    blocks, block = [], []
    for t in row[begin:end]:
        if t.breaks or t.furniture:
            blocks.append("".join(block))
            block = []
        elif t.text:
            block.append(t.text)
    blocks.append("".join(block))
    cleaned = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in cleaned if b)


def learn(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """From the sample's counts of kinds; element names beyond the fixed lists count as one kind each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                totals.update(kind_counts(page.as_py() or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in totals], pa.string()), pa.array([i for _, i in totals], pa.bool_()), pa.array(list(totals.values()), pa.int64())], ["kind", "inside", "n"])

    chosen = pages.select("page_id").where("html IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    counted = pages.join(F.broadcast(chosen), "page_id").select("html").mapInArrow(count, "kind string, inside boolean, n bigint")
    rows = counted.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()  # kinds of the fixed lists
    return learnt({(r["kind"], r["inside"]): r["n"] for r in rows})


def extracted(pages: DataFrame, weights: Weights, out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html``; a column named like ``out`` is replaced."""
    rows = pages.drop(out)
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{out}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), weights) for p in batch.column(names.index("html"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out])

    return rows.mapInArrow(run, schema)

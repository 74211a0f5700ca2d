"""Operator 9, main text by the maximum-scoring subsequence.

A page is a sequence of tags and words. Words score positive and tags negative; one linear scan finds the contiguous
region with the largest sum, of equal ones the first and shortest. The weights are learned from pages that label themselves, by one article element or
one main element, as log-odds of words and tags inside against outside. The label serves to learn: when a page is read, the scan
knows nothing of it, but that what surrounds the labelling element isn't held against it.

- a word's weight, another one for words of links, and one for each tag;
- the weight of a surrounding: an element's name or a part of its class, id or role. Words whose surroundings weigh less
  than OFF (an advert's class, a menu's element) are no article text: they cost the scan COST a run, and are left out of
  the region's text.

PRIOR_NAMES and PRIOR_CLASSES mean menus, adverts, forms, comments and the like wherever they stand, within an article too: a label says
where the article is, not that all in it is text. So what pages show can't make them content. Other names weigh nothing until
PAGES pages have shown them.

At most SAMPLE pages, chosen by hash, give the weights; counts are made on the executors in one pass, and the driver gets at most KINDS rows."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, pieces, table

SAMPLE, KINDS, PAGES = 1000, 20_000, 5
#: Surroundings below this weight are no article text; what a run of them costs the scan; words that a prior stands for.
OFF, COST, PRIOR = -1.5, 0.5, 60.0
#: Weights stay between these.
LEAST_WORD, MOST_WORD, LEAST_TAG, MOST_TAG = 0.25, 1.5, -3.25, -0.02

# HTML element names by their role.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
SECTIONS = frozenset("nav aside header footer form head menu dialog fieldset select button svg canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements that end when one of the same group begins, and what the search for them doesn't leave.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("article aside body div main section nav header footer form table ul ol dl td th blockquote figure fieldset button select object html".split())

# Names that the prior takes for menus, headers, footers, sidebars, notices, adverts, forms and reader comments.
PRIOR_NAMES = SECTIONS
PRIOR_CLASSES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu menubar breadcrumb breadcrumbs masthead header footer sidebar notice cookie cookies consent gdpr popup modal paywall newsletter login signup subscribe form comment comments commentlist replies disqus discussion complementary contentinfo".split())
#: Words of a class that says what an element goes with, not what it is; and those that an article's own parts bear.
_WITHOUT = frozenset("has with no non without".split())
_OWN = frozenset("article post entry content story main".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_MARKED = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Weights before any page is seen; the names of all other tags weigh as "<".
DEFAULT = {"word": 1.0, "linked": -1.0, "<": -0.1, "<a": -0.2, "<li": -1.0, "<ul": -1.0, "<div": -2.0, "<section": -1.0, "<table": -1.0, "<tr": -0.5, "<td": -0.5, "<p": -0.05, "<h1": -0.05, "<h2": -0.05, "<h3": -0.1}


def items(html: str) -> Iterator[tuple[str, str, str]]:
    """(name, "open" or "close" or "text", attributes or text) in page order; comments and raw elements are left out."""
    at, n = 0, len(html)
    missing: set[str] = set()
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            break
        if lt > at:
            yield "", "text", html[at:lt]
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4) if "-->" not in missing else -1
            if end < 0:
                missing.add("-->")
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                at = end + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, lt) or _LOOSE.match(html, lt)
        if not m:
            yield "", "text", "<"
            at = lt + 1
            continue
        name, at = m[2].lower(), m.end()
        if m[1]:
            yield name, "close", ""
        elif name in RAW:
            if name in missing:
                continue
            end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(html, at)
            if end:
                at = end.end()
            else:
                missing.add(name)
                at = n if name in ("script", "style") else at
            yield name, "raw", ""
        else:
            yield name, "open", m[3]
    if at < n:
        yield "", "text", html[at:]


def _surroundings(name: str, attributes: str, content: bool) -> list[str]:
    """What an element is, for all that it holds: its name, if it names a part of a page, and words of class, id and role."""
    found = [f"<{name}>"] if name in SECTIONS and not (name == "header" and content) else []
    if not attributes or name in ("html", "body"):
        return found
    for m in _MARKED.finditer(attributes):
        for token in (m[2] or m[3] or m[4] or "").split():
            parts = [w.lower() for w in _WORD.findall(_CAMEL.sub(" ", token))]
            if not parts or _WITHOUT & {*parts}:
                continue
            of_article = bool(_OWN & {*parts})
            for w in {parts[0], parts[-1]}:
                if w in _OWN or w in ("header", "banner") and (of_article or content or name[0] == "h" and name[1:].isdigit()):
                    continue
                found.append(f".{w}")
    return found


class Item:
    """A text or a tag: its kind, its name, its text, the surroundings in force, and whether it is inside the labelling element."""

    __slots__ = ("inside", "kind", "name", "off", "text")

    def __init__(self, kind: str, name: str, text: str, off: frozenset, inside: bool) -> None:
        self.kind, self.name, self.text, self.off, self.inside = kind, name, text, off, inside


_NONE: frozenset = frozenset()


def _is_comment(attributes: str) -> bool:
    return bool({".comment", ".comments", ".reply", ".replies"} & {*_surroundings("", attributes, False)})


def read(html: str) -> tuple[list[Item], int]:
    """The page's items, and how many labelling elements it has: articles that are no comments, else main elements.

    p, li, dt, dd, tr, td, th and option end where HTML lets them end without a tag; what an end tag closes doesn't reach
    out of the block it stands in, but for blocks themselves."""
    found = list(items(html))
    articles = [k for k, (name, what, value) in enumerate(found) if what == "open" and name == "article" and not _is_comment(value)]
    mains = [k for k, (name, what, _) in enumerate(found) if what == "open" and name == "main"]
    labels = {*articles} or {*mains}
    only = len(labels) == 1
    out: list[Item] = []
    stack: list[tuple[str, frozenset, bool, bool]] = []  # name; surroundings, inside, content up to and with it
    open_ = Counter()
    off, inside, content, links, n_labels = _NONE, False, False, False, 0

    def pop() -> str:
        nonlocal off, inside, content
        name = stack.pop()[0]
        open_[name] -= 1
        _, off, inside, content = stack[-1] if stack else ("", _NONE, False, False)
        return name

    def close(names: tuple, reach: bool) -> None:
        if not any(open_[x] for x in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    pop()
                return
            if not reach and stack[k][0] in SCOPES:
                return

    for k, (name, what, value) in enumerate(found):
        if what == "text":
            out.append(Item("linked" if links else "word", "", value, off, inside))
            continue
        if what == "raw":
            continue
        if name == "a":
            links = what == "open"
        elif name in BLOCKS:
            links = False
        if what == "close":
            within = off  # an end tag belongs to the element that it ends
            close((name,), name in BLOCKS and name not in ("p", "li", "dt", "dd", "option"))
            out.append(Item(f"<{name}", name, "", within, inside))
            continue
        if name in BLOCKS:
            close(("p",), False)
        if name in ENDED_BY:
            close(ENDED_BY[name], False)
        if k in labels:
            n_labels += not inside
            if off and not inside:  # menus and the like that were never closed
                while stack and stack[-1][0] not in ("body", "div", "section", "article", "main"):
                    pop()
        if k in labels and (only or not off):
            off, marks = _NONE, []
        else:
            marks = _surroundings(name, value, content)
        own = bool(value) and name not in ("html", "body") and bool(_OWN & {w.lower() for m in _MARKED.finditer(value) for w in _WORD.findall(m[2] or m[3] or m[4] or "")})
        if name not in VOID and (name in BLOCKS or marks):
            off = off.union(marks) if marks else off
            inside, content = inside or k in labels, content or own or name in ("article", "main")
            stack.append((name, off, inside, content))
            open_[name] += 1
        out.append(Item(f"<{name}", name, "", off, inside))
    return out, n_labels


class Weights:
    """Weights of words, tags and surroundings; those of sets of surroundings are remembered."""

    def __init__(self, known: dict[str, float]) -> None:
        self.known = DEFAULT | known
        self._off: dict[frozenset, bool] = {_NONE: False}

    def surrounding(self, name: str) -> float:
        found = self.known.get(name)
        return found if found is not None else _log_odds(0, 0, name)

    def off(self, names: frozenset) -> bool:
        found = self._off.get(names)
        if found is None:
            if len(self._off) > 50_000:
                self._off = {_NONE: False}
            found = self._off[names] = any(self.surrounding(x) < OFF for x in names)
        return found


def _log_odds(inside: int, outside: int, name: str) -> float:
    """Of a surrounding: words inside against outside. Those of the prior have been outside for PRIOR words, and never inside."""
    if name[1:].rstrip(">") in (PRIOR_CLASSES if name[0] == "." else PRIOR_NAMES):
        return math.log(5.0 / (outside + PRIOR + 5.0))
    return math.log((inside + 5.0) / (outside + 5.0))


def region(found: list[Item], weights: Weights) -> tuple[int, int]:
    """The best contiguous region."""
    get, other = weights.known.get, weights.known["<"]
    best, best_at, total, start, before = 0.0, (0, 0), 0.0, 0, False
    for k, x in enumerate(found):
        bad = weights.off(x.off)
        if bad:
            total -= 0.0 if before else COST
        elif x.text:
            total += len(x.text.split()) * get(x.kind, 0.0)
        else:
            total += get(x.kind, other)
        before = bad
        if total > best:
            best, best_at = total, (start, k + 1)
        elif total <= 0:
            total, start = 0.0, k + 1
    return best_at


def main_text(html: str | None, weights: Weights, scan: bool = True, left_out: bool = True) -> str:
    """Blocks of the best region, joined by blank lines; with scan=False, of the whole page. left_out=False keeps what the
    surroundings would leave out of them."""
    found, _ = read(html or "")
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        if block := " ".join("".join(parts).split()):
            blocks.append(block)
        parts.clear()

    for x in found[slice(*region(found, weights))] if scan else found:
        if x.name in BLOCKS:
            close()
        elif not left_out or not weights.off(x.off):
            parts.append(unescape(x.text) if x.text else " " if x.name == "br" else "")
    close()
    return "\n\n".join(blocks)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pages with one label: words and tags inside and outside, by kind and by all surroundings in force; and their pages."""
    for given in batches:
        inside, outside, seen = Counter(), Counter(), Counter()
        for html in given.column(0).to_pylist():
            found, labels = read(html or "")
            if labels != 1:
                continue
            here = set()
            for x in found:
                key = x.kind, x.off
                (inside if x.inside else outside)[key] += len(x.text.split()) if x.text else 1
                here.add(key)
            seen.update(here)
        kinds = list(seen)
        columns = {"kind": [k for k, _ in kinds], "off": [sorted(off) for _, off in kinds], "i": [inside[k] for k in kinds], "o": [outside[k] for k in kinds], "pages": [seen[k] for k in kinds]}
        yield batch(_COUNTS, columns)


_COUNTS = pa.schema([("kind", pa.string()), ("off", pa.list_(pa.string())), ("i", pa.int64()), ("o", pa.int64()), ("pages", pa.int64())])


def fitted_weights(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from at most so many pages; the defaults and priors alone where none labels itself.

    Surroundings are weighed by the words that they hold, words and tags where no surrounding explains them already."""
    ids = pages.where("page_id IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    some = pages.join(F.broadcast(ids), "page_id").select("html")  # bounded by sample
    counts = some.transform(mapped, _counts, "kind string, off array<string>, i long, o long, pages long").groupBy("kind", "off").agg(F.sum("i").alias("i"), F.sum("o").alias("o"), F.sum("pages").alias("pages"))
    rows = counts.orderBy(F.desc(F.col("i") + F.col("o")), "kind", "off").limit(KINDS).collect()
    around: dict[str, Counter] = {}
    for r in rows:
        for name in r.off if r.kind in ("word", "linked") else ():
            around.setdefault(name, Counter()).update(i=r.i, o=r.o, pages=r.pages)
    first = Weights({name: _log_odds(c["i"], c["o"], name) for name, c in around.items() if c["pages"] >= PAGES})
    known, plain = first.known, {}
    for r in rows:
        if not first.off(frozenset(r.off)):
            plain.setdefault(r.kind, Counter()).update(i=r.i, o=r.o)
    for kind, c in plain.items():
        prior = 1 / (1 + math.exp(-known.get(kind, known["<"])))
        odds = math.log((c["i"] + PRIOR * prior) / (c["o"] + PRIOR * (1 - prior)))
        least, most = {"word": (LEAST_WORD, MOST_WORD), "linked": (-MOST_WORD, MOST_WORD)}.get(kind, (LEAST_TAG, MOST_TAG))
        known[kind] = min(most, max(least, odds))
    return Weights(known)


_RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def page_texts(pages: DataFrame, weights: Weights) -> DataFrame:
    """pages(page_id, url, html, ...) -> page_id, url, text, n_chars; one row per row of pages.

    A null or empty page has an empty text; without pages the result is empty. Null ids and urls stay null, rows that
    repeat are read each, very long pages whole, other columns are not looked at."""
    sent = pages.sparkSession.sparkContext.broadcast(weights.known)  # bounded by KINDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(sent.value)
        for given in batches:
            htmls = given.column(2).to_pylist()
            for a, b in pieces(htmls):
                texts = [main_text(h, own) for h in htmls[a:b]]
                yield batch(_RESULT, {"page_id": given.column(0).slice(a, b - a), "url": given.column(1).slice(a, b - a), "text": texts, "n_chars": [len(t) for t in texts]})

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").transform(mapped, run, "page_id long, url string, text string, n_chars long")


def op9_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return page_texts(pages, fitted_weights(pages))

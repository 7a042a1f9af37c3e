"""HTML extraction: the maximum-scoring contiguous region of a page.

A page is a sequence of words and tags. A word scores the log odds of belonging to
the main text given the elements that are open around it (their names, classes,
ids and roles); a tag scores the log odds of standing inside the main text, zero at
most. The weights are fitted to pages whose main text is known, towards prior
weights for what HTML itself names; without such pages the priors remain. One
linear scan finds the best contiguous region. A block of text in it, or cut by its
bounds, is main text if its own words score more than zero in sum; as what is left
out inside the region is left out by the same scores, words lose less than they win,
and an advert between two paragraphs doesn't end the region.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._store import Stash, first_by_hash
from .hosts import path_of

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What these hold isn't text of the page ("hidden": an element that isn't shown).
SILENT = frozenset("head script style template title hidden".split())
#: Their content is not markup.
RAW = frozenset("script style textarea title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math svg canvas object".split())
#: A start tag ends an open element of its own kind, if no element of the second list stands between.
CLOSES_OWN = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("ul ol dl table article section div main body blockquote select".split())
TOKENS = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<[!?][^>]*>|[^<]+|<""", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
ARTICLE = re.compile(r"<(?:article|main)[\s>]", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)

#: Prior weights of open elements: what the words of menus, headers, footers, sidebars, notices, adverts, forms and comments lose, and those of articles gain. (fixed values)
PRIOR = {
    **dict.fromkeys("nav menu footer aside form dialog fieldset button select textarea input label option datalist iframe noscript".split(), -8.0),
    **dict.fromkeys(".nav .navbar .menu .sidebar .footer .ad .ads .advert .banner .cookie .notice .comments .comment .newsletter .navigation .contentinfo .search".split(), -8.0),
    "header": -6.0, "article>header": 0.0, "article": 3.0, "main": 3.0, "beside": -4.0, "a": -2.0, "li": -0.5, "": 1.0,
}
#: Prior scores of tags. (fixed values)
TAGS = dict.fromkeys("a li nav footer aside form header".split(), -0.5)
#: What any other tag scores at most, and least; bounds of a word's score; how strongly weights keep to their priors.
TAG, TAG_LEAST, MOST, LEAST, HOLD = -0.1, -1.0, 4.0, -1.0, 2.0
#: Fitting uses at most so many pages, the first by a hash of page_id.
MAX_PAGES = 500


def features(name: str, attributes: str, in_article: bool) -> list[str]:
    """What an open element tells about its words."""
    out = [f"article>{name}" if name == "header" and in_article else name] if name not in INLINE or name == "a" else []
    if attributes:
        for kind, a, b, c in NAMED.findall(attributes):
            out += [f".{t}" for t in re.split(r"[^a-z0-9]+", (a or b or c).lower()) if t]
        if HIDDEN.search(attributes):
            out.append("hidden")
    return out


def events(page: str, known: dict[str, float] | None = None) -> Iterator[tuple[str, str, Counter]]:
    """("tag", name, open) and ("text", raw, open) in page order; ``open`` counts the features of the open elements (with ``known``, only those in it) and changes with them.

    "beside" is open outside of articles (and main) on a page that has one. Linear in
    the page, however its elements are nested or left open.
    """
    stack: list[tuple[str, list[str]]] = []
    places: dict[str, list[int]] = {}  # of each open name, ascending
    scopes: list[int] = []
    now: Counter = Counter()
    at, end = 0, len(page)

    def close(depth: int) -> None:
        while len(stack) > depth:
            name, told = stack.pop()
            places[name].pop()
            if name in SCOPES:
                scopes.pop()
            for f in told:
                now[f] -= 1
                if not now[f]:
                    del now[f]
            if name in ("article", "main") and not places.get("article") and not places.get("main"):
                now["beside"] = 1

    last = page.rfind(">")
    if ARTICLE.search(page):
        now["beside"] = 1
    while at < end:
        if at > last:  # no tag ends any more
            yield "text", page[at:], now
            return
        m = TOKENS.match(page, at)
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group(0)[:2] not in ("<!", "<?") or m.group(0) == "<":
                yield "text", m.group(0), now
            continue
        name = name.lower()
        if m.group(1):
            yield "tag", name, now
            if places.get(name):
                close(places[name][-1])
            continue
        if name in CLOSES_OWN and places.get(name) and (not scopes or places[name][-1] > scopes[-1]):
            close(places[name][-1])
        yield "tag", name, now
        if name in VOID or m.group(3).rstrip().endswith("/") and name in ("svg", "path"):
            continue
        told = features(name, m.group(3), bool(places.get("article") or places.get("main")))
        if known is not None:
            told = [f for f in told if f in known or f in SILENT]
        places.setdefault(name, []).append(len(stack))
        if name in SCOPES:
            scopes.append(len(stack))
        stack.append((name, told))
        now.update(told)
        if name in ("article", "main"):
            now.pop("beside", None)
        if name in RAW:
            found = re.compile(rf"</{name}\b", re.I).search(page, at)
            stop = found.start() if found else end
            if stop > at:
                yield "text", page[at:stop], now
            at = stop


def is_block(name: str) -> bool:
    """Whether a tag ends a block of text; ``br`` does."""
    return name not in INLINE or name == "br"


class Scorer:
    """weights of open features (that of "" counts for every word) and scores of tags."""

    def __init__(self, weights: dict[str, float] | None = None, tags: dict[str, float] | None = None):
        self.weights, self.tags = dict(PRIOR if weights is None else weights), dict(TAGS if tags is None else tags)

    def word(self, now: Counter) -> float:
        total = self.weights.get("", 0.0)
        for f in now:
            total += self.weights.get(f, 0.0)
        return max(LEAST, min(MOST, total))

    def tag(self, name: str) -> float:
        return min(0.0, self.tags.get(name, TAG))


def region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the greatest sum, the first of equals; empty when nothing is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def extract(page: str | None, scorer: Scorer) -> str:
    """The main text: blocks in page order, white space turned into one space; empty if there is none."""
    scores: list[float] = []
    blocks: list[list] = [[0, 0, 0.0, []]]  # first event, one past the last, score, text
    key, value = None, 0.0
    for kind, text, now in events(page or "", scorer.weights):
        if kind == "tag":
            scores.append(scorer.tag(text))
            key = None
            if is_block(text):
                blocks.append([len(scores), len(scores), 0.0, []])
            continue
        if not SILENT.isdisjoint(now):
            scores.append(0.0)
            continue
        if key is None:  # only tags change what is open
            key, value = True, scorer.word(now)
        text = html.unescape(text)
        score = value * len(text.split())
        scores.append(score)
        block = blocks[-1]
        block[1] = len(scores)
        block[2] += score
        block[3].append(text)
    a, b = region(scores)
    kept = (" ".join("".join(x[3]).split()) for x in blocks if x[2] > 0 and x[0] < b and x[1] > a)
    return " ".join(t for t in kept if t)


def observe(page: str | None, main: str | None) -> Counter:
    """(kind, what, inside) -> count: for a known main text, the words by their open features and the tags by name, inside or outside of it.

    A block counts as inside if most of its word triples stand in the main text; a
    shorter one between such blocks isn't counted.
    """
    out: Counter = Counter()
    words = (main or "").split()
    known = set(zip(words, words[1:], words[2:]))
    if not known:
        return out
    seen: list[tuple[str, object, int]] = []
    text: list[tuple[tuple[str, ...], list[str]]] = []
    marks: list[bool | None] = []

    def flush() -> None:
        if not text:
            return
        got = " ".join(t for _, ts in text for t in ts).split()
        mark = None
        if len(got) >= 3:
            mark = 2 * sum(t in known for t in zip(got, got[1:], got[2:])) > len(got) - 2
        for told, ts in text:
            seen.append(("word", told, len(" ".join(ts).split())))
            marks.append(mark)
        text.clear()

    for kind, what, now in events(page or ""):
        if kind == "tag":
            if is_block(what):
                flush()
            seen.append(("tag", what, 1))
            marks.append(None)
        elif SILENT.isdisjoint(now):
            text.append((tuple(sorted(now)), [html.unescape(what)]))
    flush()
    hits = [i for i, m in enumerate(marks) if m]
    if not hits:
        return out
    for i, ((kind, what, n), mark) in enumerate(zip(seen, marks)):
        within = hits[0] <= i <= hits[-1]
        if kind == "tag":
            out[kind, (what,), within] += n
        elif mark is not None or not within:
            out[kind, what, bool(mark)] += n
    return out


def fit(counts: dict[tuple, float], steps: int = 200) -> Scorer:
    """Weights by logistic regression on counted contexts, held to the priors; tags by smoothed log odds."""
    by: dict[tuple, list[float]] = {}
    tags: dict[str, list[float]] = {}
    for (kind, what, inside), n in counts.items():
        (by.setdefault(what, [0.0, 0.0]) if kind == "word" else tags.setdefault(what[0], [0.0, 0.0]))[not inside] += n
    scorer = Scorer()
    if by:
        contexts = sorted(by)
        names = ["", *sorted({f for c in contexts for f in c})]
        at = {f: i for i, f in enumerate(names)}
        x = [np.array([0, *(at[f] for f in c)]) for c in contexts]
        # a context's evidence grows with the logarithm of its words, so that no page outweighs the others
        n = np.array([by[c] for c in contexts])
        n *= (10 * np.log1p(n.sum(axis=1)) / n.sum(axis=1))[:, None]
        prior = np.array([PRIOR.get(f, 0.0) for f in names])
        w, flat, rows = prior.copy(), np.concatenate(x), np.repeat(np.arange(len(x)), [len(r) for r in x])
        scale = np.bincount(flat, n.sum(axis=1)[rows] * np.array([len(r) for r in x])[rows], len(names)) / 4 + HOLD  # bounds the curvature
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[flat], len(x)), -30, 30)))
            slope = np.bincount(flat, (n[:, 0] - n.sum(axis=1) * p)[rows], len(names)) - HOLD * (w - prior)
            w += slope / scale
        scorer.weights |= dict(zip(names, w.tolist()))
    sums = [1 + sum(t[k] for t in tags.values()) for k in (0, 1)]
    for name, (a, b) in tags.items():
        scorer.tags[name] = max(TAG_LEAST, min(TAG, math.log((a + 0.5) / sums[0]) - math.log((b + 0.5) / sums[1])))
    return scorer


def known_ids(pages: DataFrame) -> DataFrame:
    """(page_id, doc_id): pages whose url ends in the id of the document they show."""
    path = path_of(F.col("url").cast("string"))
    tail = F.nullif(F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), tail.try_cast("long").alias("doc_id")).where("page_id IS NOT NULL AND doc_id IS NOT NULL")


def train(pages: DataFrame, docs: DataFrame, max_pages: int = MAX_PAGES) -> Scorer:
    """Fits to at most max_pages pages whose document is there (chosen by id, before any html is read); tasks count, the driver gets the counts."""
    spark = pages.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Stash(spark) as stash:
        known = stash.save(known_ids(pages).join(texts.select("doc_id"), "doc_id", "left_semi"), "known")
        chosen = stash.save(first_by_hash(known, ["page_id", "doc_id"], max_pages), "chosen")
        shown = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
        rows = shown.join(F.broadcast(chosen), "page_id").join(texts.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi"), "doc_id").select("html", "text")

        def run(batches):
            total: Counter = Counter()
            for batch in batches:
                for page, main in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    total.update(observe(page, main))
            keys = list(total)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([list(k[1]) for k in keys], pa.list_(pa.string())), pa.array([k[2] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())], names=["kind", "what", "inside", "n"])

        counted = rows.mapInArrow(run, "kind string, what array<string>, inside boolean, n long").groupBy("kind", "what", "inside").agg(F.sum("n").alias("n")).collect()
    return fit({(r.kind, tuple(r.what), r.inside): float(r.n) for r in sorted(counted, key=lambda r: (r.kind, r.what, r.inside))})


def main_text(pages: DataFrame, scorer: Scorer) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every page, in any number of equal rows.

    Null or empty html gives an empty text, null ids and urls stay null, a page
    where nothing scores above zero is empty; of equally good regions the first
    counts. Other columns are ignored; an empty table gives none.
    """

    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                texts = [extract(p, scorer) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    cols = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return cols.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def extract_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    return main_text(pages, train(pages, docs))

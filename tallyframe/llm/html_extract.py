"""Main text of web pages: a linear-chain conditional random field over the DOM's leaf blocks.

A page becomes a sequence of text blocks with the tags and attribute words of their ancestors. A chain of two
labels (main text or not) is trained on labelled pages: a bounded sample of those whose markup states what is
the article, each also with its tags replaced by plain ones and with labelled comments, forms, sidebars and
notices put in. Viterbi decoding labels all blocks of a page together. Results for odd rows: a null or empty
html gives an empty text; a page without any labelled page to learn from is decoded by an empty model (nothing
is main text); long, deep and broken pages take a time in proportion to their length; repeated rows repeat; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import arrow_map, kind_of

#: Bound of the fit: labelled pages (before their variants).
SAMPLE_PAGES = 120

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes template svg math select".split())
FOREIGN = {"svg", "math"}  # of RAW: these may close themselves
TO_THE_END = set("script style textarea title".split())  # of RAW: without an end tag, the rest of the page is theirs
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img input button".split()
)
CONTROLS = {"button", "label"}  # parts of forms, wherever they stand: their text is left out
CLOSES_P = set(
    "address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table td th tr ul".split()
)
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol menu dl table select html body".split())

# What labelled markup says. Elements and attribute words of main text and of everything else.
ARTICLE_TAGS, ARTICLE_WORDS = {"article", "main"}, {"articlebody", "main", "article"}
OTHER_TAGS = set("nav footer aside form header menu dialog button fieldset".split())
OTHER_WORDS = set(
    "ad ads advert advertisement banner sponsored promo menu nav navigation navbar breadcrumb footer header sidebar "
    "related comments comment respond reply replies cookie consent notice alert popup modal share social newsletter "
    "subscribe form widget".split()
)

# Possessive: a tag is scanned once from its start, whatever follows.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>")
_START = re.compile(r"</?[a-zA-Z][^\s/>]*+")
_STEP = re.compile(r"[^<>\"']++|\"[^\"]*+\"|'[^']*+'|<")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…:;,]")
#: All that labels look at.
_LABELLING = frozenset(ARTICLE_TAGS | ARTICLE_WORDS | OTHER_TAGS | OTHER_WORDS)
#: Matches every page whose markup names an article, and some others.
NAMES = r"(?i)(?<![a-z])(?:articlebody|article|main)(?![a-z])"


#: Depth up to which a labelled page is learnt from: a block's features are its ancestors.
LEARNT_DEPTH = 256


@dataclass
class Block:
    tag: str
    tags: frozenset[str]  # of the ancestors
    words: frozenset[str]  # attribute words of all ancestors
    text: str
    linked: int  # characters of the text that lie in links
    depth: int = 0


class _Tags:
    """The tags of a page, found in a time in proportion to its length. From the last '>' on there are none. Where a scan
    fails for want of a closing quote, so does every scan that comes to one of the places that it passed outside quotes;
    these are remembered, so no stretch is scanned more often than there are kinds of quotes."""

    def __init__(self, page: str):
        self.page, self.last, self.failed = page, page.rfind(">"), set()

    def next(self, at: int) -> re.Match | tuple[int, int] | None:
        """The next tag from ``at`` on, or (start, end) of the next comment, whichever comes first."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3
            if start > self.last:
                at = page.find("<!--", start)
                if at < 0:
                    return None
                continue
            if not (self.failed and self._fails(start)):
                match = _TAG.match(page, start)
                if match:
                    return match
                self._fails(start)
            at = start + 1
        return None

    def _fails(self, start: int) -> bool:
        """Whether a tag that starts here never ends; if so, what the scan passed is noted."""
        name = _START.match(self.page, start)
        if not name:
            return False
        at, passed = name.end(), []
        while at not in self.failed:
            step = _STEP.match(self.page, at)
            if not step:
                if self.page.startswith(">", at):
                    return False
                break
            passed.append(at)
            at = step.end()
        self.failed.update(passed)
        return True


def blocks(page: str, known: frozenset[str] | set[str] | None = None) -> list[Block]:
    """The leaf blocks with text, in page order; markup, comments, scripts, styles, form controls and the head are left
    out. ``known``, if given, holds the only tags and words that ancestors are described by; then the time is in
    proportion to the page's length, whatever its depth."""
    out: list[Block] = []
    names: list[str] = []
    places: dict[str, list[int]] = {}  # where the open elements of a name stand
    scopes: list[int] = []
    outer: list[int] = []  # where block elements stand
    words: list[frozenset[str]] = [frozenset()]
    tags: list[frozenset[str]] = [frozenset()]
    parts: list[str] = []
    linked, links, hidden = 0, 0, 0
    unclosed: set[str] = set()
    ends: dict[str, re.Pattern] = {}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            if text:
                out.append(Block(names[outer[-1]] if outer else "", tags[-1], words[-1], text, linked, len(names)))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal links, hidden
        name = names.pop()
        at = len(names)
        places[name].pop()
        words.pop()
        tags.pop()
        if scopes and scopes[-1] == at:
            scopes.pop()
        if outer and outer[-1] == at:
            outer.pop()
        links -= name == "a"
        hidden -= name == "head" or name in CONTROLS

    found, at = _Tags(page), 0
    while match := found.next(at):
        start, end = match if isinstance(match, tuple) else match.span()
        if start > at and not hidden:
            piece = page[at:start]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = end
        if isinstance(match, tuple) or match[2] is None:
            continue
        name = match[2].lower()
        if name == "br":
            parts.append(" ")
            continue
        if match[1]:
            if not places.get(name):
                if name not in INLINE:
                    flush()
                continue
            if name in INLINE and outer and outer[-1] > places[name][-1]:
                continue  # an inline end tag does not close blocks
            if name not in INLINE:
                flush()
            while names[-1] != name:
                pop()
            pop()
            continue
        if name not in INLINE:
            flush()
            if name in CLOSES_P:
                while places.get("p") and places["p"][-1] >= (scopes[-1] if scopes else 0):
                    pop()
            if name in IMPLIED:
                scope = scopes[-1] if scopes else -1
                inner = [own[i] for own in map(places.get, IMPLIED[name]) if own and (i := bisect_right(own, scope)) < len(own)]
                while inner and len(names) > min(inner):
                    pop()
            if name == "body":
                hidden = 0
        if name in VOID or match[3].endswith("/") and (name in FOREIGN or name not in RAW):
            continue
        if name in RAW:  # only its own end tag counts
            pattern = ends.setdefault(name, re.compile(f"</{re.escape(name)}\\b[^>]*+>", re.I))
            close = None if name in unclosed else pattern.search(page, at, found.last + 1)
            if close:
                at = close.end()
            elif name in TO_THE_END:
                at = len(page)
            else:
                unclosed.add(name)
            continue
        places.setdefault(name, []).append(len(names))
        if name in SCOPES:
            scopes.append(len(names))
        own_words, own_tags = words[-1], tags[-1]
        if name not in INLINE:
            outer.append(len(names))
            if name not in own_tags and (known is None or name in known):
                own_tags = own_tags | {name}
        names.append(name)
        if match[3]:
            new = {w for m in _ATTRIBUTE.finditer(match[3]) for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())}
            new = (new if known is None else new & known) - own_words
            own_words = own_words | new if new else own_words
        words.append(own_words)
        tags.append(own_tags)
        links += name == "a"
        hidden += name == "head" or name in CONTROLS
    if not hidden and at < len(page):
        parts.append(page[at:])
    flush()
    return out


def labels(found: list[Block]) -> list[int] | None:
    """What the markup says of each block; None if it names no article."""
    if not any(ARTICLE_TAGS & b.tags or ARTICLE_WORDS & b.words for b in found):
        return None
    return [
        int(bool(ARTICLE_TAGS & b.tags or ARTICLE_WORDS & b.words) and not (OTHER_TAGS & b.tags or OTHER_WORDS & b.words))
        for b in found
    ]


def features(block: Block, place: int, count: int) -> list[str]:
    """Of ancestors: tags, attribute words. Of the text: length, share in links, marks, position."""
    n = len(block.text)
    return [
        "bias", f"tag {block.tag}", *(f"in {t}" for t in block.tags if t not in ("html", "body")), *(f"word {w}" for w in block.words),
        f"length {min(8, n.bit_length())}", f"linked {block.linked * 4 // max(n, 1)}",
        f"marks {sum(1 for _ in islice(_SENTENCE.finditer(block.text), 4))}", f"place {place * 4 // count}", f"last {place == count - 1}",
        f"copyright {block.text[0] in '©®'}",
    ]


@dataclass
class Chain:
    """Two-label linear chain: a weight row per feature, start and step weights."""

    index: dict[str, int]
    emit: np.ndarray  # features x 2
    step: np.ndarray  # 2 x 2
    start: np.ndarray  # 2

    @functools.cached_property
    def names(self) -> frozenset[str]:
        """The tags and words that have weights."""
        return frozenset(f.partition(" ")[2] for f in self.index if f.startswith(("in ", "word ")))

    def decode(self, found: list[Block]) -> list[int]:
        """The best label sequence, by Viterbi."""
        n = len(found)
        scores = np.array([
            self.emit[[self.index[f] for f in features(b, i, n) if f in self.index]].sum(axis=0) for i, b in enumerate(found)
        ]).reshape(-1, 2).tolist()
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        x, y = (a + b for a, b in zip(self.start.tolist(), scores[0]))
        back = []
        for e0, e1 in scores[1:]:
            back.append((int(y + s10 > x + s00), int(y + s11 > x + s01)))
            x, y = max(x + s00, y + s10) + e0, max(x + s01, y + s11) + e1
        state = int(y > x)
        path = [state]
        for step in reversed(back):
            state = step[state]
            path.append(state)
        return path[::-1]


def train(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = 150, penalty: float = 1e-3) -> Chain:
    """Maximum likelihood with a square penalty, by adaptive gradient steps; forward-backward over all at once."""
    index: dict[str, int] = {}
    for rows, _ in sequences:
        for row in rows:
            for f in row:
                index.setdefault(f, len(index))
    chain = Chain(index, np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2))
    if not sequences:
        return Chain({"bias": 0}, np.array([[0.0, -1.0]]), np.zeros((2, 2)), np.zeros(2))
    length, n = max(len(y) for _, y in sequences), len(sequences)
    mask, gold = np.zeros((n, length), bool), np.zeros((n, length), int)
    where, which = [], []
    for s, (rows, y) in enumerate(sequences):
        mask[s, : len(y)], gold[s, : len(y)] = True, y
        for t, row in enumerate(rows):
            where += [s * length + t] * len(row)
            which += [index[f] for f in row]
    where, which = np.array(where), np.array(which)
    onehot = np.eye(2)[gold] * mask[..., None]
    pairs = np.einsum("sta,stb,st->ab", onehot[:, :-1], onehot[:, 1:], mask[:, 1:].astype(float)) if length > 1 else np.zeros((2, 2))
    observed = [np.zeros_like(chain.emit), pairs, onehot[:, 0].sum(axis=0)]
    np.add.at(observed[0], which, onehot.reshape(-1, 2)[where])
    params, squares = [chain.emit, chain.step, chain.start], [np.zeros_like(p) for p in (chain.emit, chain.step, chain.start)]
    for _ in range(rounds):
        scores = np.zeros((n * length, 2))
        np.add.at(scores, where, params[0][which])
        scores = scores.reshape(n, length, 2)
        forward, backward = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        forward[:, 0] = params[2] + scores[:, 0]
        for t in range(1, length):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + params[1], axis=1) + scores[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        for t in range(length - 2, -1, -1):
            new = np.logaddexp.reduce(params[1] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        single = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        double = np.exp(forward[:, :-1, :, None] + params[1] + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
        expected = [np.zeros_like(params[0]), (double * mask[:, 1:, None, None]).sum(axis=(0, 1)), single[:, 0].sum(axis=0)]
        np.add.at(expected[0], which, single.reshape(-1, 2)[where])
        for p, o, e, g2 in zip(params, observed, expected, squares):
            gradient = (o - e) / n - penalty * p
            g2 += gradient**2
            p += 0.5 * gradient / (np.sqrt(g2) + 1e-8)
    return chain


def variants(page: str, borrowed: str) -> Iterator[tuple[str, str]]:
    """(page to label, page to learn from): as it is, with plain tags, with more kinds of other blocks, and both.
    ``borrowed`` is article-like text of another page, for comments that read like an article."""
    words = re.sub(r"[<>&]", " ", borrowed)
    inner = (
        f'<div class="ad"><p>{words[:120]}</p></div><div class="share"><ul><li><a href="#">{words[:20]}</a></li></ul></div>'
    )
    after = (
        f'<section class="comments"><h3>{words[:30]}</h3><div class="comment"><p>{words[:300]}</p></div>'
        f'<div class="comment"><p>{words[300:420]}</p></div></section><aside class="sidebar related"><h3>{words[:25]}</h3>'
        f'<ul><li><a href="/x">{words[5:60]}</a></li><li><a href="/y">{words[60:100]}</a></li></ul><p>{words[:200]}</p></aside>'
        f'<form class="newsletter"><label>{words[:40]}</label><p>{words[40:160]}</p><button>{words[:10]}</button></form>'
    )
    before = (
        f'<header class="header"><p>{words[:60]}</p></header><div class="notice cookie consent"><p>{words[:220]}</p></div>'
    )
    richer = page.replace("<body>", "<body>" + before, 1)
    close = next((t for t in ("</article>", "</main>") if t in richer), None)  # of what is labelled
    richer = richer.replace(close, inner + close + after, 1) if close else richer.replace("</body>", after + "</body>", 1)
    for one in (page, richer):
        yield one, one
        plain = one
        for tag, new in (("article", '<div class="post entry content">'), ("main", '<div class="page">'),
                         ("nav", '<div class="nav menu">'), ("footer", '<div class="footer">'), ("aside", '<div class="sidebar">'),
                         ("header", '<div class="header">')):
            plain = re.sub(rf"<{tag}\b[^>]*>", new, plain)
            plain = plain.replace(f"</{tag}>", "</div>")
        yield one, plain


def labelled_pages(pages: DataFrame, count: int) -> list[str]:
    """At most ``count`` pages whose markup names an article with text, by hash of id and content, for every size of
    the table and every share of such pages; none only if the table has none."""
    named = pages.where(F.col("html").rlike(NAMES))
    total = named.count()
    parts = 1 << 30
    place = F.pmod(F.xxhash64("page_id", "html"), F.lit(parts))
    share = min(parts, int(parts * (2 * count + 20) / max(total, 1)))

    def run(cols: dict[str, list]) -> dict[str, list]:
        rows = [(p, at) for p, at in zip(cols["html"], cols["place"]) if any(labels(found := blocks(p, _LABELLING)) or []) and max(b.depth for b in found) <= LEARNT_DEPTH]
        return {"html": [p for p, _ in rows], "place": [at for _, at in rows]}

    while True:
        drawn = named.select("html", place.alias("place")).where(F.col("place") < share)
        found = arrow_map(drawn, run, "html string, place long").orderBy("place", F.xxhash64("html")).limit(count).collect()
        if len(found) == count or share == parts:
            return [r["html"] for r in found]
        share = min(parts, share * 8)


def fit(pages: list[str]) -> Chain:
    sequences = []
    for i, page in enumerate(pages):
        other = " ".join(b.text for b in blocks(pages[i - 1]) if len(b.text) > 80)[:600]
        for stated, shown in variants(page, other):
            given, seen = blocks(stated), blocks(shown)
            truth = labels(given)
            if truth and len(seen) == len(given):
                sequences.append(([features(b, t, len(seen)) for t, b in enumerate(seen)], truth))
    return train(sequences)


def main_text(page: str | None, chain: Chain) -> str:
    found = blocks(page or "", chain.names)
    return " ".join(b.text for b, label in zip(found, chain.decode(found)) if label)


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    chain = pages.sparkSession.sparkContext.broadcast(fit(labelled_pages(pages, sample_pages)))

    def run(cols: dict[str, list]) -> dict[str, list]:
        texts = [main_text(p, chain.value) for p in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": list(map(len, texts))}

    schema = f"page_id {kind_of(pages, 'page_id')}, url string, text string, n_chars long"
    return arrow_map(pages.select("page_id", "url", "html"), run, schema)

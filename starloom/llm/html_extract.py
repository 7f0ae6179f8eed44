"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element that can matter (blocks, and inline elements with a class, id or
role) is a binary variable: *content* when main text lies in its subtree.
Unary potentials are smoothed log-odds of the element's tag, of what its names
hint at, and of its subtree's text length, link share and sentence marks;
parent-child potentials say how often a child of a content parent is content
itself, by tag (a child of a boilerplate parent never is). Sum-product message
passing, once upward and once downward, gives exact marginals on the tree; a
piece of text stays when its owner's marginal reaches one half.

Elements that name themselves as something else are boilerplate for certain
by tag, role or name, so their tags teach nothing; their inside counts for the
size, link and sentence features only. Outside landmarks a name with a bad word
says so, unless that word may be a topic and stands beside another word
(``social-science``). Below a landmark a name must say nothing else: ``ads``,
or bad words and layout words only (``cookie-consent``, ``share-buttons``).
A name that is not certain is one feature, and such elements teach nothing.
The header of an article (``entry-header``) is a part of it.

The potentials are counts over labelled pages: pages with an ``article`` or
``main`` landmark label themselves (text in the landmark, outside elements
that name themselves as something else, which are boilerplate for certain). Counting is one Spark aggregate over
a hashed share of about ``TRAIN_PAGES`` landmark pages (all of them when there are fewer);
the collected table is bounded by the fixed lists of tags and bins. Extraction
is one pass over all pages, page by page, without a shuffle.

Defined cases: a null or empty page, or one without content, gives an empty
text. Comments, scripts, styles and an unfinished tag at the end of a cut page
are dropped; text around them stays. Rows that repeat are each extracted.
Null ids and urls pass through. Other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import small_batches

TRAIN_PAGES = 2000

# Element names of HTML, and words that name a page's parts.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe title svg object select textarea button head".split())
RAW = frozenset("script style noscript template iframe title textarea".split())
BAD_TAGS = frozenset("nav header footer aside form menu dialog".split())
GOOD_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = frozenset("article main body html".split())
BAD_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disclaimer footer form gdpr header login masthead menu modal nav navbar navigation
newsletter notice overlay pager pagination popup privacy promo promotion promoted recommended related reply replies
respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget""".split())
GOOD_WORDS = frozenset("article content entry main post story".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
GOOD_ROLES = frozenset("main article".split())
ABSENT = frozenset("with has no without".split())  # "with-sidebar" names the layout, not the part
OWN_WORDS = frozenset("ad ads advert advertisement comment comments related reply replies sponsored promo promoted".split())
TOPIC_WORDS = frozenset("""advertising banner consent cookie cookies copyright disclaimer form menu notice overlay privacy promotion
related reply respond search share sharing social widget""".split())
PART_WORDS = frozenset("""area bar block bottom box button buttons container content fixed global icon icons inner item items left link
links list main mobile outer page panel primary region right row secondary section site sticky text title top unit user
wrap wrapper""".split())
ARTICLE_WORDS = frozenset("article entry post story".split())
CLOSES_P = BLOCKS - {"html", "body", "dt", "dd", "li", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(\bhidden\b)""")
_NAME = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SENTENCE = re.compile(r"[.!?,;:]")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
NONE, BAD, GOOD, MAYBE = 0, 1, 2, 3


def _hint(tag: str, attrs: str, landmark: bool = False) -> int:
    """What an element's names say about it: BAD (not main text), GOOD, or NONE; MAYBE is a bad word below a ``landmark``.

    There a name is certain only if all its words are among ``OWN_WORDS``, or if it has several and all
    are bad or layout words: others are as often topics. Elsewhere topics need a word beside them.
    """
    good, maybe = tag in GOOD_TAGS, False
    if tag in BAD_TAGS:
        return BAD
    if attrs and ("=" in attrs or "hidden" in attrs):
        for name, value, hidden in _ATTR.findall(attrs):
            if hidden:
                return BAD
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                bad = OWN_WORDS if tag in WHOLE else BAD_WORDS
                for token in value.split():
                    found = _NAME.findall(_HUMP.sub("-", token).lower())
                    if not ABSENT.isdisjoint(found):
                        continue
                    named = bad.intersection(found)
                    if named and not (named == {"header"} and not ARTICLE_WORDS.isdisjoint(found)):
                        anchor = name == "id" and (tag in HEADINGS or tag == "section")  # named after a heading's words
                        parts = bad | PART_WORDS
                        if landmark and tag not in WHOLE:
                            sure = OWN_WORDS.issuperset(found) or len(found) > 1 and not anchor and parts.issuperset(found)
                        else:
                            sure = tag in WHOLE or not TOPIC_WORDS.issuperset(named) or parts.issuperset(found)
                        if sure:
                            return BAD
                        maybe = maybe or name != "id" or tag not in HEADINGS
                    good = good or not GOOD_WORDS.isdisjoint(found)
                continue
            value = value.lower()
            if name == "role":
                if value in BAD_ROLES:
                    return BAD
                good = good or value in GOOD_ROLES
            elif name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                return BAD
    return MAYBE if maybe else GOOD if good else NONE


class Page:
    """The variables of one page and the pieces of text they own."""

    __slots__ = ("parent", "tag", "hint", "landmark", "pieces", "size", "linked", "marks")

    def __init__(self, source: str):
        self.parent, self.tag, self.hint, self.landmark = [-1], ["body"], [NONE], [False]
        self.pieces: list[tuple[int, int, str]] = []  # (block, owner, text)
        self.size, self.linked, self.marks = [0], [0], [0]
        self._parse(source)
        for i in range(len(self.parent) - 1, 0, -1):
            p = self.parent[i]
            self.size[p] += self.size[i]
            self.linked[p] += self.linked[i]
            self.marks[p] += self.marks[i]

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("body", 0)]
        open_tags: Counter = Counter()
        block = pos = link = 0
        skip: list[str] = []  # a skipped element and the elements open in it
        skipped: Counter = Counter()
        end = len(source)

        def pop_to(depth: int) -> None:
            while len(stack) > depth:
                open_tags[stack.pop()[0]] -= 1

        def end_skip() -> None:
            skip.clear()
            skipped.clear()

        while pos < end:
            lt = source.find("<", pos)
            raw = source[pos: lt if lt >= 0 else end]
            if raw and not skip:
                text = html_lib.unescape(raw) if "&" in raw else raw
                owner = stack[-1][1]
                self.pieces.append((block, owner, text))
                n = len(text) - text.count(" ")
                self.size[owner] += n
                self.linked[owner] += n if link else 0
                self.marks[owner] += len(_SENTENCE.findall(text))
            if lt < 0:
                break
            if source.startswith("!--", lt + 1):
                close = source.find("-->", lt + 4)
                pos = close + 3 if close >= 0 else end
                continue
            if source[lt + 1: lt + 2] in ("!", "?"):
                close = source.find(">", lt)
                pos = close + 1 if close >= 0 else end
                continue
            m = _TAG.match(source, lt + 1)
            if not m:
                if not skip:
                    self.pieces.append((block, stack[-1][1], "<"))
                pos = lt + 1
                continue
            close = _tag_end(source, m.end())
            if close < 0:
                break
            tag, attrs, pos = m[2].lower(), source[m.end(): close], close + 1
            if m[1]:
                if skip and not skipped[tag] and open_tags[tag] > 0:
                    end_skip()  # its parent closes
                if skip:
                    while skipped[tag] > 0:
                        last = skip.pop()
                        skipped[last] -= 1
                        if last == tag:
                            break
                elif tag == "a":
                    link = 0
                elif open_tags[tag] > 0:
                    depth = len(stack) - 1
                    while stack[depth][0] != tag:
                        depth -= 1
                    pop_to(depth)
                if tag in BLOCKS:
                    block, link = block + 1, 0
                continue
            if tag in RAW:
                found = _RAW_END[tag].search(source, pos)
                close = _tag_end(source, found.end()) if found else -1
                pos = close + 1 if close >= 0 else end
                continue
            if tag == "body" or tag == "html":  # also ends a head that was left open
                end_skip()
                continue
            if skip or tag in SKIPPED:
                if not attrs.endswith("/") and tag not in VOID:
                    skip.append(tag)
                    skipped[tag] += 1
                continue
            if tag in VOID:
                if tag == "br":
                    self.pieces.append((block, stack[-1][1], " "))
                elif tag == "hr":
                    block += 1
                continue
            if tag == "a":
                link = 1
            is_block = tag in BLOCKS
            if is_block:
                block, link = block + 1, 0
                if tag in CLOSES_P and open_tags["p"] > 0:
                    depth = len(stack) - 1
                    while stack[depth][0] != "p":
                        depth -= 1
                    pop_to(depth)
                if tag in CLOSES:
                    ends, within = CLOSES[tag]
                    depth, top = len(stack) - 1, 0
                    while depth > 0 and stack[depth][0] not in within:
                        if stack[depth][0] in ends:
                            top = depth
                        depth -= 1
                    if top:
                        pop_to(top)
            landmark = self.landmark[stack[-1][1]]
            hint = _hint(tag, attrs, landmark)
            if (is_block or hint) and not attrs.endswith("/"):
                self.parent.append(stack[-1][1])
                self.tag.append(tag)
                self.hint.append(hint)
                self.landmark.append(landmark or tag in GOOD_TAGS)
                self.size.append(0)
                self.linked.append(0)
                self.marks.append(0)
                stack.append((tag, len(self.tag) - 1))
                open_tags[tag] += 1

    def features(self, i: int) -> tuple[str, ...]:
        """Discrete features of one variable; each takes few values."""
        tag, n = self.tag[i], self.size[i]
        length = min(8, n.bit_length() // 2)
        links = 0 if not n else 1 + min(3, 4 * self.linked[i] // (n + 1))
        marks = 0 if not n else 1 + min(4, 100 * self.marks[i] // (n + 1))
        return (f"t:{tag if tag in BLOCKS else 'inline'}", f"h:{self.hint[i]}", f"s:{length}:{links}", f"m:{marks}")

    def labels(self) -> list[int] | None:
        """1 for variables with landmark text below them; None when the page has no landmark."""
        good = [False] * len(self.tag)
        bad = [False] * len(self.tag)
        seen = False
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            good[i] = good[p] or self.tag[i] in GOOD_TAGS
            bad[i] = bad[p] or self.hint[i] == BAD
            seen = seen or good[i]
        if not seen:
            return None
        out = [0] * len(self.tag)
        for _, owner, text in self.pieces:
            if good[owner] and not bad[owner] and not text.isspace():
                out[owner] = 1
        for i in range(len(out) - 1, 0, -1):
            if out[i]:
                out[self.parent[i]] = 1
        return out

    def text(self, content: list[bool]) -> str:
        blocks: list[str] = []
        last, parts = -1, []
        for block, owner, piece in self.pieces:
            if block != last:
                if parts:
                    blocks.append(" ".join("".join(parts).split()))
                last, parts = block, []
            if content[owner]:
                parts.append(piece)
        blocks.append(" ".join("".join(parts).split()))
        return "\n\n".join(b for b in blocks if b)


def _tag_end(source: str, at: int) -> int:
    """Place of the '>' that ends a tag; quoted values may hold one. -1 if the page ends first."""
    close = source.find(">", at)
    quote = at
    while close >= 0:
        opened = min((q for q in (source.find('="', quote, close), source.find("='", quote, close)) if q >= 0), default=-1)
        if opened < 0:
            return close
        shut = source.find(source[opened + 1], opened + 2)
        if shut < 0:
            return close
        if shut > close:
            close = source.find(">", shut)
        quote = shut + 1
    return close


class Model:
    """Log-odds of features and log-probabilities of a child's state under a content parent."""

    PRIOR = {("h:2", 1): 20.0}  # a landmark's name counts as that many examples
    DOUBT = -1.0  # log-odds of a bad word below a landmark, whose label is unknown

    def __init__(self, counts: dict[tuple[str, int], float]):
        weight = dict(counts)
        for key, n in self.PRIOR.items():
            weight[key] = weight.get(key, 0) + n
        totals: Counter = Counter()
        for (f, y), n in weight.items():
            totals[f[0], y] += n
        names = {f for f, _ in weight if not f.startswith("c:")}
        log_share = lambda f, y: math.log((weight.get((f, y), 0) + 0.5) / (totals[f[0], y] + 4))
        self.odds = {f: log_share(f, 1) - log_share(f, 0) for f in names} | {f"h:{MAYBE}": self.DOUBT}
        self.child = {}
        for f in {f for f, _ in weight if f.startswith("c:")} | {"c:"}:
            one, zero = weight.get((f, 1), 0) + 1, weight.get((f, 0), 0) + 1
            self.child[f] = one / (one + zero)

    def _own(self, page: Page, i: int) -> float:
        """Evidence odds of one element; names that define the labels decide as in the labels."""
        if page.hint[i] == BAD:
            return 0.0
        if page.tag[i] in GOOD_TAGS:
            return math.exp(20.0)
        return math.exp(max(-30.0, min(30.0, sum(self.odds.get(f, 0.0) for f in page.features(i)))))

    def marginals(self, page: Page) -> list[float]:
        """P(content) of every variable, exactly, by one upward and one downward pass."""
        n = len(page.tag)
        child, parent = self.child, page.parent
        own = [self._own(page, i) for i in range(n)]
        # a boilerplate parent has boilerplate children only, so its message from a child is (1, q) with
        # q = P(child's evidence | parent content) / P(child's evidence | parent boilerplate)
        q, prior = [1.0] * n, [0.5] * n
        up = own  # evidence odds of each subtree, content : boilerplate
        for i in range(n - 1, 0, -1):
            tag = page.tag[i]
            p1 = prior[i] = child.get(f"c:{tag if tag in BLOCKS else 'inline'}", child["c:"])
            q[i] = (1 - p1) + p1 * up[i]
            p = parent[i]
            if up[p]:
                up[p] = min(max(up[p] * q[i], 1e-250), 1e250)
        out = [0.0] * n
        out[0] = up[0] / (1 + up[0])
        for i in range(1, n):  # P(child content) = P(parent content) * P(child content | parent content, its subtree)
            out[i] = out[parent[i]] * prior[i] * up[i] / q[i]
        return out

    def extract(self, source: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        return page.text([m >= 0.5 for m in self.marginals(page)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for source in batch.column("html").to_pylist():
            page = Page(source or "")
            labels = page.labels()
            if labels is None:
                continue
            inside = [False] * len(labels)  # in an element that names itself as something else
            doubt = list(inside)  # in an element whose label is unknown
            for i, y in enumerate(labels):
                inside[i] = page.hint[i] == BAD or bool(i) and inside[page.parent[i]]
                doubt[i] = page.hint[i] == MAYBE or bool(i) and doubt[page.parent[i]]
                if page.hint[i] == BAD or doubt[i]:
                    continue
                features = page.features(i)
                for f in features[2:] if inside[i] else features:
                    counts[f, y] += 1
                if i and labels[page.parent[i]]:
                    tag = page.tag[i]
                    counts[f"c:{tag if tag in BLOCKS else 'inline'}", y] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([f for f, _ in counts], pa.string()), pa.array([y for _, y in counts], pa.int32()),
         pa.array(list(counts.values()), pa.float64())], names=["feature", "label", "n"])


def train(pages: DataFrame, max_pages: int = TRAIN_PAGES) -> Model:
    """Count potentials over a hashed share of about ``max_pages`` landmark pages."""
    small_batches(pages.sparkSession)
    marked = pages.filter(F.col("html").cast("string").rlike(r"(?i)<(?:article|main)[\s/>]"))
    total = marked.count()
    share = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    sample = marked.filter(share < max_pages / total) if total > max_pages else marked
    counts = sample.select(F.col("html").cast("string").alias("html")).mapInArrow(
        _count, "feature string, label int, n double").groupBy("feature", "label").agg(F.sum("n").alias("n"))
    return Model({(r.feature, r.label): r.n for r in counts.collect()})


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html, ...)``."""
    small_batches(pages.sparkSession)
    model = model or train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(s) for s in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

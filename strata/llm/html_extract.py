"""Main text of web pages: boosted trees over DOM nodes, decoded as a hierarchy.

Every element with text gets features: its tag, the words of its class, id and
role, the same of the elements around it, its depth, its place among its
siblings, and the density of text, links and blocks below it. Gradient-boosted
trees turn them into log-odds of being part of the article. Taken one by one
the answers could contradict each other, a kept paragraph inside a dropped
comment section; instead the best consistent labelling of the tree is found,
in which nothing is kept below a dropped element, by one pass up (the value of
keeping a subtree) and one pass down.

The trees learn from pages whose labels are known because they are put
together here: layouts drawn from a grammar of common page parts, filled with
sentences and links of a bounded sample of the given pages.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import boosting
from strata.llm.html_tree import INLINE, Tree

#: Pages whose sentences fill the training pages, and how many of these.
SAMPLE_PAGES = 200
TRAIN_SENTENCES = 20_000
TRAIN_PAGES = 1200

#: What class, id and role words say about a part of a page.
GROUPS = {
    "menu": "nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs topbar toolbar tabs pagination pager skip sitemap",
    "header": "header masthead banner branding logo topline siteheader hero",
    "footer": "footer foot copyright colophon legal imprint bottom credits",
    "side": "sidebar side aside rail widget widgets related recommended recommendations popular trending more also complementary teaser teasers archive tags tagcloud",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal overlay toast warning disclaimer paywall privacy",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted adsense dfp outbrain taboola commercial",
    "form": "form search searchbox login signin signup register subscribe subscription newsletter contact optin",
    "comment": "comment comments commentlist disqus reply replies respond response responses discussion thread reviews feedback guestbook reader readers",
    "social": "share sharing social follow tweet facebook twitter whatsapp likes",
    "main": "article articles content main post entry story body text page maincontent blogpost prose news",
    "meta": "meta byline author date time published info avatar bio",
}
_GROUP_OF = {w: k for k, words in enumerate(GROUPS.values()) for w in words.split()}
_N = len(GROUPS)
TAGS = ("nav header footer aside form article main section div p ul ol li table pre blockquote figure h1 h2 h3 "
        "button select label dialog span a td details menu").split()
_TAG_OF = {t: k for k, t in enumerate(TAGS)}
_NAMES = frozenset(("class", "id", "role", "itemprop", "aria-label"))
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"[\s\x1c-\x1f]+")
#: Elements whose text never is text of the page.
SILENT = frozenset("script style noscript template head title button select option textarea input svg object iframe".split())


def _groups(tree: Tree, e: int, seen: dict[str, np.ndarray]) -> np.ndarray:
    raw = tree.attributes[e]
    found = seen.get(raw)
    if found is None:
        found = np.zeros(_N, dtype=np.float32)
        for w in _WORDS.findall(tree.attribute(e, _NAMES)):
            k = _GROUP_OF.get(w.lower())
            if k is not None:
                found[k] = 1
        if len(seen) < 10_000:
            seen[raw] = found
    return found


def node_features(tree: Tree) -> np.ndarray:
    """A row of features for every element."""
    n = tree.size
    parent = np.array(tree.parent)
    last = np.array(tree.last)
    own = np.zeros((n, 8))  # chars, words, link chars, ends, commas, digits, pieces, capitals
    link = np.zeros(n, dtype=bool)
    silent = np.zeros(n, dtype=bool)
    depth = np.zeros(n)
    seen: dict[str, np.ndarray] = {}
    group = np.zeros((n, _N), dtype=np.float32)
    above = np.zeros((n, _N), dtype=np.float32)
    above_tag = np.zeros((n, 7), dtype=np.float32)
    tags = np.full(n, len(TAGS))
    for e in range(1, n):
        up, tag = parent[e], tree.tag[e]
        depth[e] = depth[up] + 1
        link[e] = link[up] or tag == "a"
        silent[e] = silent[up] or tag in SILENT
        k = _TAG_OF.get(tag)
        if k is not None:
            tags[e] = k
        if tree.attributes[e]:
            group[e] = _groups(tree, e, seen)
        above[e] = np.maximum(above[up], group[up])
        above_tag[e] = above_tag[up]
        if up and tags[up] < 7:
            above_tag[e, tags[up]] = 1
    for e, t, _ in tree.texts:
        if silent[e]:
            continue
        words = t.split()
        if words:
            size = sum(map(len, words))
            own[e] += (size, len(words), size * link[e], t.count(".") + t.count("!") + t.count("?"), t.count(","),
                       sum(map(str.isdigit, t)) if size < 200 else 0, 1, sum(w[0].isupper() for w in words))

    def below(column: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(column)])
        return total[last + 1] - total[:n]

    sums = np.column_stack([below(own[:, k]) for k in range(own.shape[1])])
    is_p = tags == _TAG_OF["p"]
    counts = np.column_stack([below(x.astype(float)) for x in (
        is_p, tags == _TAG_OF["a"], tags == _TAG_OF["li"], np.isin(tags, [_TAG_OF[t] for t in ("h1", "h2", "h3")]),
        np.array([t in ("input", "button", "select", "textarea", "label") for t in tree.tag]),
        np.array([t not in INLINE for t in tree.tag]))])
    groups_below = np.column_stack([below(group[:, k].astype(float)) for k in range(_N)]) > group
    siblings = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n, dtype=int)
    order = np.zeros(n)
    same_tag = np.zeros(n)
    at: dict[int, int] = {}
    kinds: dict[tuple[int, int], int] = {}
    for e in range(1, n):
        up = tree.parent[e]
        order[e] = at.get(up, 0)
        at[up] = at.get(up, 0) + 1
        key = (up, int(tags[e]))
        kinds[key] = kinds.get(key, 0) + 1
    for e in range(1, n):
        same_tag[e] = kinds[(tree.parent[e], int(tags[e]))] - 1
    up = np.maximum(parent, 0)
    chars, words = np.maximum(sums[:, 0], 1), np.maximum(sums[:, 1], 1)
    blocks = np.maximum(counts[:, 5], 1)
    before = np.concatenate([[0.0], np.cumsum(own[:, 0])])[:n]
    page = max(sums[0, 0], 1)
    family = siblings[up].astype(float)
    one_hot = np.zeros((n, len(TAGS) + 1))
    one_hot[np.arange(n), tags] = 1
    return np.column_stack([
        one_hot[:, :-1], group, above, groups_below, above_tag,
        depth, np.log1p(sums[:, 0]), np.log1p(sums[:, 1]), sums[:, 2] / chars, sums[:, 3] / words, sums[:, 4] / words,
        sums[:, 5] / chars, sums[:, 0] / words, sums[:, 7] / words, np.log1p(sums[:, 1] / blocks),
        np.log1p(counts[:, 0]), counts[:, 1] / words, counts[:, 2] / blocks, counts[:, 3], counts[:, 4],
        order, family, order / np.maximum(family, 1), same_tag / np.maximum(family, 1),
        sums[:, 0] / np.maximum(sums[up, 0], 1), sums[:, 0] / page, before / page, (page - before - sums[:, 0]) / page,
        np.log1p(sums[up, 1]), sums[up, 2] / np.maximum(sums[up, 0], 1), np.log1p(counts[up, 0]),
        np.log1p(own[:, 1]), own[:, 0] / chars,
    ]).astype(np.float32)


def with_text(tree: Tree) -> np.ndarray:
    """Which elements have text of their own or below them."""
    has = np.zeros(tree.size + 1)
    for e, t, _ in tree.texts:
        if t and not t.isspace():
            has[e + 1] += 1
    total = np.cumsum(has)
    return total[np.array(tree.last) + 1] > total[:-1]


def consistent_labels(tree: Tree, odds: np.ndarray) -> np.ndarray:
    """The labelling of greatest summed log-odds in which every element below
    a dropped one is dropped. A tie keeps."""
    worth = odds.copy()
    for e in range(tree.size - 1, 0, -1):  # children come after their parents
        if worth[e] > 0:
            worth[tree.parent[e]] += worth[e]
    keep = worth >= 0
    for e in range(1, tree.size):
        keep[e] &= keep[tree.parent[e]]
    return keep


def blocks_of(tree: Tree, keep: np.ndarray) -> list[str]:
    """The kept text, a string per block."""
    silent = np.zeros(tree.size, dtype=bool)
    for e in range(1, tree.size):
        silent[e] = silent[tree.parent[e]] or tree.tag[e] in SILENT
    blocks: dict[int, list[str]] = {}
    for e, t, block in tree.texts:
        if keep[e] and not silent[e]:
            blocks.setdefault(block, []).append(t)
    texts = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks.values())
    return [t for t in texts if t]


def judged(tree: Tree) -> np.ndarray:
    """The elements that get labels of their own: block-level ones with text.
    Inline elements go with the block they are in."""
    block = np.array([t not in INLINE and t not in SILENT for t in tree.tag])
    block[0] = False
    return block & with_text(tree)


def main_text(tree: Tree, odds: np.ndarray) -> str:
    return "\n\n".join(blocks_of(tree, consistent_labels(tree, odds)))


class PageMaker:
    """Training pages: parts in common layouts, filled with given sentences.

    MARK before a text says that it belongs to the article.
    """

    MARK = "\ue000"

    def __init__(self, sentences: list[str], seed: int = 11):
        self.r = random.Random(seed)
        self.sentences = sentences or ["Lorem ipsum dolor sit amet, consectetur adipiscing elit."]
        self.words = [w for s in self.sentences[:500] for w in s.split()[:3]] or ["lorem"]

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def text(self, low: int, high: int) -> str:
        picked = (self.r.choice(self.sentences) for _ in range(self.r.randint(low, high)))
        return " ".join(s.replace("&", "&amp;").replace("<", "&lt;") for s in picked)

    def some_words(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(low, high))).replace("<", "").replace("&", "")

    def attributes(self, kind: str, hidden: float) -> str:
        if self.chance(hidden):
            return self.r.choice(["", ' class="row"', ' class="box"', ' class="col-md-8"', ' id="x1"', ' class="wrap"'])
        word = self.r.choice(GROUPS[kind].split())
        name = self.r.choice(["{}", "{}", "site-{}", "{}-wrapper", "main_{}", "{}-block", "js-{}", "{} clearfix", "c-{}__inner"]).format(word)
        return f' {self.r.choice(["class", "class", "class", "id"])}="{name}"'

    def part(self, kind: str, tags: str, inner: str, hidden: float = 0.06) -> str:
        tag = self.r.choice(tags.split())
        bare = tag not in ("div", "section", "ul", "p") and self.chance(0.6)
        return f"<{tag}{'' if bare else self.attributes(kind, hidden)}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        made = [f'<a href="/{k}">{self.some_words(1, 3)}</a>' for k in range(self.r.randint(low, high))]
        return f"<ul>{''.join(f'<li>{a}</li>' for a in made)}</ul>" if self.chance(0.7) else " | ".join(made)

    def paragraph(self, mark: str = "", low: int = 1, high: int = 6) -> str:
        t = mark + (self.some_words(1, 9) if self.chance(0.12) else self.text(low, high))
        if self.chance(0.25):
            cut = t.find(" ", len(t) // 2) + 1
            tag = self.r.choice(["b", "em", "a href='#'", "i", "span", "strong"])
            t = f"{t[:cut]}<{tag}>{mark}{t[cut:]}</{tag.split()[0]}>"
        if self.chance(0.12):
            t = f"<b>{t}<br>"
        return f"<p>{t}" if self.chance(0.12) else f"<p>{t}</p>"

    def heading(self, level: str, mark: str = "") -> str:
        return f"<{level}>{mark}{self.some_words(3, 9)}</{level}>"

    def ad(self) -> str:
        inner = self.r.choice([self.text(1, 2), self.paragraph(), f'<a href="/go">{self.some_words(2, 6)}</a>', self.text(2, 4)])
        return self.part("ad", "div div div aside section ins", inner)

    def notice(self) -> str:
        button = "<button>OK</button>" if self.chance(0.5) else '<a href="/ok">ok</a>'
        return self.part("notice", "div div section aside", self.paragraph(high=3) + button)

    def form(self) -> str:
        inner = f"<p>{self.some_words(3, 9)}</p><label>{self.some_words(1, 2)}</label><input name=q><button>go</button>"
        form = f"<form action=/s>{inner}</form>"
        return self.part("form", "div section", form) if self.chance(0.6) else form

    def side(self) -> str:
        widgets = "".join(self.part("side", "div section", self.heading("h3") + self.r.choice(
            [self.links(2, 8), self.paragraph(high=2), self.paragraph(high=3) + self.links(1, 3)]), 0.3)
            for _ in range(self.r.randint(1, 3)))
        return self.part("side", "aside aside div div section", widgets)

    def comments(self) -> str:
        one = lambda: self.part("comment", "div li article", (
            f"<p>{self.some_words(1, 2)}</p>" if self.chance(0.5) else "") + self.paragraph(high=5), 0.2)
        inner = (self.heading("h3") if self.chance(0.7) else "") + "".join(one() for _ in range(self.r.randint(1, 6)))
        return self.part("comment", "section div div ol", inner + (self.form() if self.chance(0.4) else ""), 0.02)

    def clutter(self) -> str:
        return self.r.choice([self.ad, self.notice, self.form, self.side, lambda: self.part("social", "div ul", self.links(2, 5)),
                              lambda: self.part("menu", "nav div", self.links(2, 6))])()

    def body(self) -> str:
        m, r = self.MARK, self.r
        out = [self.heading("h1", m)] if self.chance(0.8) else []
        for _ in range(r.choice([1, 1, 2, 3, 4, 5, 6, 8, 10, 12])):
            pick = r.random()
            if pick < 0.74:
                out.append(self.paragraph(m))
            elif pick < 0.80:
                out.append(self.heading(r.choice(["h2", "h3"]), m))
            elif pick < 0.84:
                out.append("<ul>" + "".join(f"<li>{m}{self.text(1, 1)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif pick < 0.87:
                out.append(f"<blockquote>{self.paragraph(m, high=2)}</blockquote>")
            elif pick < 0.89:
                out.append("<table>" + "".join(f"<tr><td>{m}{self.some_words(1, 3)}</td><td>{m}{self.some_words(1, 3)}</td></tr>" for _ in range(3)) + "</table>")
            elif pick < 0.91:
                out.append(f"<pre>{m}{self.text(1, 2)}</pre>")
            elif pick < 0.93:
                out.append(f"<div>{m}{self.text(1, 3)}</div>")
            else:
                out.append(self.clutter())
        return "".join(out)

    def article(self) -> str:
        inner = self.body()
        for _ in range(self.r.choice([0, 1, 1, 1, 2, 3])):
            tag = self.r.choice(["article", "article", "main", "div", "div", "section"])
            if self.chance(0.3):
                inner = f"<div{self.attributes('main', 0.5)}>{inner}</div>"
            bare = tag in ("article", "main") and self.chance(0.7)
            inner = f"<{tag}{'' if bare else self.attributes('main', 0.25)}>{inner}</{tag}>"
        return inner

    def page(self) -> str:
        top = [x for p, x in ((0.3, self.notice), (0.6, lambda: self.part("header", "header header div", self.heading(
            self.r.choice(["h1", "h2", "p"])) + (self.links(1, 4) if self.chance(0.5) else self.paragraph(high=1)))),
            (0.8, lambda: self.part("menu", "nav nav div ul", self.links(3, 9))), (0.4, self.ad), (0.2, self.form)) if self.chance(p)]
        end = [x for p, x in ((0.3, lambda: self.part("social", "div ul section", self.links(2, 5))), (0.3, self.side),
                              (0.45, self.comments), (0.3, self.ad), (0.2, self.form), (0.2, self.notice)) if self.chance(p)]
        self.r.shuffle(end)
        foot = self.part("footer", "footer footer footer div", "&copy; " + self.some_words(1, 3) + " &middot; " + self.text(1, 2) + (
            self.links(1, 5) if self.chance(0.4) else ""))
        middle = (self.side() if self.chance(0.2) else "") + self.article() + "".join(x() for x in end)
        if self.chance(0.4):
            middle = f"<div{self.attributes('main', 0.7)}>{middle}</div>"
        return ("<html><head><title>t</title></head><body>" + "".join(x() for x in top) + middle
                + (foot if self.chance(0.85) else "") + "</body></html>")


def page_sentences(page: str | None) -> list[str]:
    """The sentences of a whole page."""
    tree, out = Tree(page or ""), []
    for e, t, _ in tree.texts:
        if tree.tag[e] not in SILENT:
            out += [s.strip() for s in re.findall(r"[^.!?\n]{12,400}[.!?]", t)]
    return out


def training_set(sentences: list[str], made: int = TRAIN_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the judged elements of ``made`` training pages,
    filled with ``sentences``. An element is kept if any text below it is the
    article's."""
    maker = PageMaker(sorted(set(sentences)))
    xs, ys = [], []
    for _ in range(made):
        tree = Tree(maker.page())
        y = np.zeros(tree.size)
        for k, (e, t, block) in enumerate(tree.texts):
            if maker.MARK in t:
                tree.texts[k] = (e, t.replace(maker.MARK, ""), block)
                while e >= 0 and not y[e]:
                    y[e] = 1
                    e = tree.parent[e]
        rows = judged(tree)
        xs.append(node_features(tree)[rows])
        ys.append(y[rows])
    return np.concatenate(xs), np.concatenate(ys)


def learn(pages: DataFrame, page_id: str, html: str) -> boosting.Trees:
    """Trees from at most TRAIN_SENTENCES sentences of SAMPLE_PAGES whole pages,
    both those with the least hash. Only hashes and the sentences chosen leave
    the tasks."""
    hashed = pages.where(F.col(html).isNotNull()).select(F.xxhash64(page_id, html).alias("h"), F.col(html).alias("html"))
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(page_sentences(page.as_py()), pa.string())], names=["s"])
    sentences: list[str] = []
    if least:
        found = hashed.where(F.col("h").isin(least)).select("html").mapInArrow(cut, "s string").distinct()
        sentences = [r["s"] for r in found.orderBy(F.xxhash64("s"), "s").limit(TRAIN_SENTENCES).collect()]
    return boosting.fit(*training_set(sentences), trees=60, depth=5)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    NULL, empty and text-less pages have the empty text. NULL ids and urls are
    passed through, repeated rows give a row each, other columns are ignored.
    An empty table gives no rows.
    """
    narrow = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    sent = pages.sparkSession.sparkContext.broadcast(learn(narrow, "page_id", "html"))  # a few thousand numbers

    def texts(pages: list[str]) -> Iterator[str]:
        held: list[Tree] = []
        rows: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[str]:
            if not held:
                return
            which = [judged(t) for t in held]
            odds = sent.value.log_odds(np.concatenate([x[w] for x, w in zip(rows, which, strict=True)]))
            at = 0
            for tree, w in zip(held, which, strict=True):
                all_odds = np.zeros(tree.size)
                all_odds[w] = odds[at:at + w.sum()]
                at += w.sum()
                yield main_text(tree, all_odds)
            held.clear()
            rows.clear()

        for p in pages:
            held.append(Tree(p or ""))
            rows.append(node_features(held[-1]))
            size += held[-1].size
            if size > 10_000:
                yield from flush()
                size = 0
        yield from flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(texts(x.as_py() for x in batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    schema = narrow.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return narrow.mapInArrow(run, schema)

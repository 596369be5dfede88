"""A forgiving HTML reader: the element tree of a page as flat lists.

It reads what browsers accept: unclosed and misnested elements, attributes
without quotes, comments, raw-text elements, character references without
their semicolon, and pages that break off anywhere.
"""

from __future__ import annotations

import html
import re
from collections import Counter

#: Fixed values from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: An opening tag of the key ends open elements of these names, up to a barrier.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
        "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
BARRIER = frozenset("ul ol dl table article section div main body html td th select form aside nav".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
#: Behind the last ">": a tag, comment or declaration that the page breaks off in.
_OPEN_END = re.compile(r"<(?:/?[a-zA-Z]|/?\Z|[!?])")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:@][\w:.@-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")


class Tree:
    """Elements in page order: ``parent``, ``tag``, ``attributes`` (raw text),
    and ``last`` (the last element below). ``texts`` holds (element, decoded
    text, block) in page order; a new block begins where a block-level element
    starts or ends. Element 0 is the page itself."""

    def __init__(self, page: str):
        self.parent, self.tag, self.attributes, self.last = [-1], [""], [""], [0]
        self.texts: list[tuple[int, str, int]] = []
        stack = [0]
        opened: Counter[str] = Counter()  # open elements per name
        at = 0
        end, whole = len(page), page.rfind(">") + 1  # tags end before ``whole``
        if m := _OPEN_END.search(page, whole):
            end = m.start()

        block = 0

        def pop_to(depth: int) -> int:
            """Leave the elements from ``depth`` on; block-level ones among them."""
            left = 0
            for e in stack[depth:]:
                self.last[e] = len(self.tag) - 1
                left += self.tag[e] not in INLINE
                opened[self.tag[e]] -= 1
            del stack[depth:]
            return left

        lowered = None
        while at < end:
            m = _TOKEN.search(page, at, end) if at < whole else None
            until = m.start() if m else end
            if until > at:
                self.texts.append((stack[-1], html.unescape(page[at:until]), block))
            if not m:
                break
            at = m.end()
            closing, name = m.group(1), m.group(2)
            if name is None:
                continue
            name = name.lower()
            if closing and not opened[name]:
                continue
            if closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == name:
                        block += pop_to(depth)
                        break
                    if self.tag[stack[depth]] in ("table", "td", "th") and name in INLINE | {"p"}:
                        break
                continue
            ends = {"p"} if name in CLOSES_P else ENDS.get(name, ())
            if any(opened[x] for x in ends):
                for depth in range(len(stack) - 1, 0, -1):
                    tag = self.tag[stack[depth]]
                    if tag in ends:
                        block += pop_to(depth)
                        if name in CLOSES_P:
                            break
                    elif tag in BARRIER:
                        break
            self.parent.append(stack[-1])
            self.tag.append(name)
            self.attributes.append(m.group(3))
            self.last.append(len(self.tag) - 1)
            block += name not in INLINE
            if name == "br":
                self.texts.append((stack[-1], " ", block))
            if name in VOID or m.group(3).endswith("/") and name not in CLOSES_P and name not in INLINE:
                continue
            if name in RAW:
                lowered = lowered or page.lower()
                if len(lowered) != len(page):  # some letters change length
                    lowered = re.sub("[A-Z]", lambda c: c.group().lower(), page)
                close = lowered.find(f"</{name}", at)
                at = page.find(">", close) + 1 if close >= 0 else len(page)
                at = at or len(page)
                continue
            stack.append(len(self.tag) - 1)
            opened[name] += 1
        pop_to(0)
        self.size = len(self.tag)

    def attribute(self, element: int, names: frozenset[str]) -> str:
        """The values of the attributes ``names`` of an element, joined."""
        raw = self.attributes[element]
        if not raw:
            return ""
        return " ".join(html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw) if k.lower() in names and v)

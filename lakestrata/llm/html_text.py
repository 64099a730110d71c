"""HTML extraction (operator 2): the main text of a page by tree scoring.

The page becomes a tree. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are left out, by element, role or words of class and id. Each paragraph passes points for its length and commas to its
ancestors, fewer with each level; an element's points are discounted by the share of its text that is in
links. The best container is kept with those siblings that score well or read like text. The text of its blocks is
joined in page order by one space; white space inside a block becomes one space.

Inside an article or main element a word of class or id leaves a part out only if the name says nothing else: a part named
``share`` or ``comments-list`` goes, one named ``share-story`` stays.

Cases: null or empty html gives empty text. A page without any paragraph of some length gives the text of its body
without the parts above. Open elements are closed by the rules for paragraphs, list items and table parts; nesting
depth is not limited, as nothing recurses. A page is read once, in time in proportion to its length whatever it holds:
unclosed tags, quotes and elements, stray end tags, deep nesting. Of equally good containers the last one is taken. Repeated
pages are treated alike; an empty table gives no rows; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import documents, map_texts, unpacked

_name_end = re.compile(r"[\s/>]")
_comment_end = re.compile(r"--!?>")
_special = re.compile(r"""[>"']""")
_attribute = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template textarea title svg math canvas object video audio xmp noframes".split())
LEFT_OUT = frozenset("nav header footer aside form button select option label fieldset dialog menu head datalist".split()) | RAW
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article body center div dl main section table tbody td tr blockquote html figure details".split())
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "li", "dd", "dt", "summary"}
# What opening an element ends, and the elements beyond which it ends nothing.
ENDS = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt", "p"}, {"dl"}),
    "dt": ({"dd", "dt", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
} | {tag: ({"p"}, {"td", "th", "button", "object"}) for tag in CLOSES_P}
MAIN = frozenset(("article", "main"))
_roles = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of class and id by which parts of a page are known; fixed values.
_unwanted = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner|breadcrumbs?|combx|comments?|commentlist|community"
    r"|disqus|cookies?|consent|gdpr|notices?|alert|disclaimer|extra|footer|foot|footnav|masthead|header|legal|menu|nav|navbar|navigation"
    r"|topbar|toolbar|sidebar|side|aside|rail|related\w*|recommend\w*|remark|replies|reply|respond|rss|share|sharing|shoutbox|skyscraper"
    r"|social|subscribe|newsletter|signup|login|popup|modal|overlay|pager|pagination|tags|widget|taboola|outbrain|tweet)(?=$|[\s_-])"
)
_wanted = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|hentry|main|page|post|story|text|blog)(?=$|[\s_-])")
# Words that a name of several words may have beside an unwanted one without saying that the part is text.
_layout = frozenset(
    "area bar block box button buttons container content group holder icon icons inline inner item items left links list panel"
    " posts right row section slot small top bottom unit wrap wrapper".split()
)
_hidden = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_sentence_end = re.compile(r"[.!?…。]['\")\]]?\s*$")
LEAST = 25  # characters of a paragraph that passes points


def _names_unwanted(names: str, in_main: bool) -> bool:
    """Whether class and id names call for leaving an element out."""
    if not _unwanted.search(names):
        return False
    if not in_main:
        return True
    for name in names.split():
        words = [w for w in re.split("[_-]", name) if w]
        unwanted = [w for w in words if _unwanted.search(w)]
        if unwanted and all(w in _layout or w.isdigit() for w in words if w not in unwanted):
            return True
    return False


class Tags:
    """The markup of a page from its beginning to its end, each part of it looked at a bounded number of times.

    A ``<`` that begins no complete tag is text. What was learned by looking ahead is kept: that no ``>`` or comment end
    follows, where the next special character is, and from where an open quote runs to the end of the page.
    """

    def __init__(self, html: str):
        self.html, self.n = html, len(html)
        self.missing: dict[str, int] = {}  # marks, and a place from which on they do not occur
        self.next: dict[re.Pattern, int] = {}  # where a pattern is next found after the last place asked for
        self.dead: set[int] = set()  # special characters outside quotes from which no tag ends

    def _find(self, mark: str, at: int) -> int:
        if at >= self.missing.get(mark, self.n):
            return -1
        found = self.html.find(mark, at)
        if found < 0:
            self.missing[mark] = at
        return found

    def _next(self, pattern: re.Pattern, at: int) -> int:
        if self.next.get(pattern, -1) < at:
            m = pattern.search(self.html, at)
            self.next[pattern] = m.start() if m else self.n
        return self.next[pattern]

    def _tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends an open tag; -1 if a quote or the page does not end before."""
        seen: list[int] = []
        place = self._next(_special, at)
        while place < self.n and place not in self.dead:
            c = self.html[place]
            if c == ">":
                return place
            seen.append(place)
            close = self._find(c, place + 1)
            if close < 0:
                break
            m = _special.search(self.html, close + 1)
            place = m.start() if m else self.n
        self.dead.update(seen)
        return -1

    def __iter__(self):
        """(start, end, kind, name, attributes): kind is ``open``, ``close`` or empty for comments and the like."""
        at, html = 0, self.html
        while (lt := html.find("<", at)) >= 0:
            at = lt + 1
            c = html[at : at + 1]
            if c == "!" or c == "?":
                if html.startswith("<!--", lt):
                    m = _comment_end.search(html, lt + 4)
                    end = m.end() if m else self.n
                elif html.startswith("<![CDATA[", lt) and (stop := self._find("]]>", lt)) >= 0:
                    end = stop + 3
                else:
                    end = self._find(">", at) + 1
                if end:
                    jump = yield lt, end, "", "", ""
                    at = max(end, jump or 0)
                continue
            close = c == "/"
            first = html[at + close : at + close + 1]
            if not (first.isascii() and first.isalpha()):
                continue
            stop = self._next(_name_end, at + close)
            end = self._find(">", stop) if close else self._tag_end(stop)
            if end >= 0:
                name, attributes = html[at + close : stop].lower(), "" if close else html[stop:end]
                jump = yield lt, end + 1, "close" if close else "open", name, attributes
                at = max(end + 1, jump or 0)


class Tree:
    """Elements as parallel lists in page order. ``parts`` of an element: its texts and the numbers of its children."""

    def __init__(self, html: str):
        self.tag, self.up, self.out, self.weight = ["html"], [-1], [False], [0.0]
        self.main = [False]  # whether the element is an article or main part, or inside one
        self.parts: list[list] = [[]]
        self._build(html)

    def _open(self, tag: str, up: int, attributes: str) -> int:
        out, weight = self.out[up] or tag in LEFT_OUT, 25.0 if tag in MAIN else 0.0
        main = tag in MAIN
        if attributes and not out:
            has = {a.lower(): b or c or d or "" for a, b, c, d in _attribute.findall(attributes)}
            names = f"{has.get('class', '')} {has.get('id', '')}".lower()
            role = has.get("role", "").lower()
            main = main or role == "main" or has.get("itemprop", "").lower() == "articlebody"
            if main:
                weight = 25.0
            if tag not in ("html", "body") and (
                role in _roles
                or "hidden" in has
                or has.get("aria-hidden", "").lower() == "true"
                or _hidden.search(has.get("style", "").lower())
                or (_names_unwanted(names, self.main[up]) and not (main and _wanted.search(names)))
            ):
                out = True
            elif _wanted.search(names):
                weight += 25.0
        self.tag.append(tag)
        self.up.append(up)
        self.out.append(out)
        self.weight.append(weight)
        self.main.append(main or self.main[up])
        self.parts.append([])
        node = len(self.tag) - 1
        self.parts[up].append(node)
        return node

    def _build(self, html: str) -> None:
        stack, n = [0], len(html)
        places: dict[str, list[int]] = {}  # of the open elements of each name, and of all blocks, in the stack
        blocks: list[int] = []

        def top(tag: str) -> int:
            return places[tag][-1] if places.get(tag) else 0

        def push(node: int, tag: str) -> None:
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                blocks.append(len(stack))
            stack.append(node)

        def cut(place: int) -> None:
            while len(stack) > place:
                tag = self.tag[stack.pop()]
                places[tag].pop()
                if tag in BLOCK:
                    blocks.pop()

        done, tags = 0, Tags(html)
        walk = iter(tags)
        item = next(walk, None)
        while item is not None:
            start, end, kind, tag, attributes = item
            if start > done:
                self._text(stack[-1], html[done:start])
            done = end
            if kind == "open" and tag in ("html", "body"):
                if tag == "body" and not top("body"):
                    cut(1)
                    push(self._open(tag, stack[-1], attributes), tag)
            elif kind == "open":
                if tag in ENDS:
                    ended, limit = ENDS[tag]
                    over = max(map(top, limit))
                    while (place := max(map(top, ended))) > over:
                        cut(place)
                        if tag not in ("li", "dd", "dt", "tr", "td", "th"):
                            break
                node = self._open(tag, stack[-1], attributes)
                if tag in RAW and not attributes.endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}", re.I).search(html, end)
                    stop = html.find(">", close.end()) if close else -1
                    done = stop + 1 if stop >= 0 else n
                elif tag not in VOID and not attributes.endswith("/"):
                    push(node, tag)
            elif kind == "close" and (place := top(tag)):
                # An inline end tag does not close a block.
                if tag in BLOCK or not blocks or blocks[-1] < place:
                    cut(place)
            try:
                item = walk.send(done)
            except StopIteration:
                item = None
        if done < n:
            self._text(stack[-1], html[done:])

    def _text(self, node: int, text: str) -> None:
        if not self.out[node]:
            self.parts[node].append(unescape(text) if "&" in text else text)

    def text(self, node: int) -> str:
        """The text of an element without what is left out; blocks and line breaks count as white space."""
        found: list[str] = []
        todo: list = [node]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                found.append(x)
                continue
            if self.out[x]:
                continue
            if self.tag[x] in BLOCK or self.tag[x] == "br":
                found.append(" ")
                todo.append(" ")
            todo.extend(reversed(self.parts[x]))
        return " ".join("".join(found).split())

    def score(self) -> tuple[list[float], list[int], list[int]]:
        """Points of each element, discounted by link density; length of its text, and of that in links."""
        n = len(self.tag)
        length, links, own, commas = [0] * n, [0] * n, [0] * n, [0] * n
        block, inside = [0] * n, [False] * n  # nearest block; whether in a link
        points = list(self.weight)
        for x in range(n):
            up = self.up[x]
            block[x] = x if x == 0 or self.tag[x] in BLOCK else block[up]
            inside[x] = self.tag[x] == "a" or (x > 0 and inside[up])
            if self.out[x]:
                continue
            for part in self.parts[x]:
                if isinstance(part, str):
                    size = len(part.strip())
                    length[x] += size
                    if inside[x]:
                        links[x] += size
                    else:
                        own[block[x]] += size
                        commas[block[x]] += part.count(",") + part.count("、") + part.count("،") + part.count("，")
        for x in range(n - 1, 0, -1):
            if not self.out[x]:
                length[self.up[x]] += length[x]
                links[self.up[x]] += links[x]
        for x in range(n):
            if own[x] < LEAST:
                continue
            gain = 1 + commas[x] + min(own[x] / 100, 3)
            if self.tag[x] in CONTAINER:
                points[x] += gain
            up, level = self.up[x], 0
            while up >= 0 and level < 5:
                points[up] += gain if level == 0 else gain / 2 if level == 1 else gain / (3 * level)
                up, level = self.up[up], level + 1
        points = [p * (1 - links[x] / length[x]) if length[x] else 0.0 for x, p in enumerate(points)]
        return points, length, links


def main_text(html: str) -> str:
    """The main text of one page."""
    tree = Tree(html)
    points, length, links = tree.score()
    body = next((x for x, tag in enumerate(tree.tag) if tag == "body"), 0)
    able = [x for x, tag in enumerate(tree.tag) if tag in CONTAINER and not tree.out[x] and length[x]]
    best = max(able, key=lambda x: (points[x], x), default=body)
    if not length[best]:
        return tree.text(body)
    # A marked article or main part holds the whole text, its heading included.
    marked = [x for x in able if tree.tag[x] in MAIN]
    if marked and best not in marked:
        over, x = -1, best
        while x >= 0:
            over = x if tree.tag[x] in MAIN else over
            x = tree.up[x]
        best = over if over >= 0 else max(marked, key=lambda x: (points[x], length[x]))
    if tree.up[best] < 0:
        return tree.text(best)
    kept = []
    for x in tree.parts[tree.up[best]]:
        if x == best:
            kept.append(x)
        elif isinstance(x, str) or tree.out[x] or not length[x]:
            continue
        elif tree.tag[best] in MAIN:
            if tree.tag[x] == tree.tag[best] and points[x] >= max(10, 0.2 * points[best]):
                kept.append(x)
        elif tree.tag[x] in CONTAINER:
            # A part of some points, or a short one that reads like text.
            reads = length[x] >= LEAST and links[x] < 0.25 * length[x]
            if points[x] >= max(10, 0.2 * points[best]) or reads and _sentence_end.search(tree.text(x)):
                kept.append(x)
        elif tree.tag[x] == "p" or tree.tag[x] in ("h1", "h2", "pre"):
            density = links[x] / length[x]
            if tree.tag[x] == "h1" or length[x] > 80 and density < 0.25 or not links[x] and _sentence_end.search(tree.text(x)):
                kept.append(x)
    return " ".join(t for t in map(tree.text, kept) if t)


def extract(pages: DataFrame, html: str = "html", keep=None) -> DataFrame:
    """``row`` (the kept columns) and ``text``, the main text of each page; no shuffle."""

    def make():
        return lambda texts: {"text": [main_text((t or b"").decode("utf-8", "replace")) for t in texts]}

    return map_texts(pages, make, "text string", html, keep)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(documents(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return unpacked(found, "text", F.length("text").cast("long").alias("n_chars"))

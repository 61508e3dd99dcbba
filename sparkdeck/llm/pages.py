"""Main text of web pages by deduction of each host's template.

*Tokens.*  A page is a row of tokens: tags (with class names and the path of
open containers, so equal tags in different places differ) and text runs (with
their path).

*Equivalence classes.*  Over the pages of one host, a token's occurrence vector
says how often each page has it.  Tokens with the same vector form a class.
The vector is never built: the exclusive-or of a hash of (page, count) over
the pages that have the token stands for it, a plain aggregation that combines
within tasks, so a host with a third of all pages is no burden to any task.
Pages of a host with the same long texts (copies) count once, so a copied
article does not pass for template.  A class is large and frequent when at
least two tokens share a vector held by ``SHARE`` of the host's pages, and by
``LEAST_PAGES``.

*Template.*  In a page, a class is valid if its tokens stand in the order of
their mean places and its span nests with those of the classes taken before
(it lies between two neighbouring tokens of each or outside).  The valid
classes, nested, are the template; the text between neighbouring template tags
is a slot, and text that belongs to the template itself is dropped.

*Region.*  The template decides where a host's articles are: from the whole page
down, the region goes to the template's element that holds over half of the text
that the host's pages have there (menus, links and readers' words not counted;
copies once), and stops where the rest stands right in the element.  In a page,
the region is the deepest such element that is valid there, with its slots.
Tags and class names only refine it: an ``article`` or ``main`` around or inside
it (with all such elements in it; of several apart, the one with the most text)
is kept whole; menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments inside it go (a name drops nothing that
encloses the article or most of its text).  Without such a tag, the headings right before
the region stay with it, and blocks of template text or links at its two ends
go; where the region is the page itself, so do the template's other elements.
Text that a host repeats stays inside an article's tag and between other text of
the region.

*Without a region.*  On a page without a valid region, a host without enough pages for
a template, or one whose text is spread, the article is by tag; without one, it
is the slot with the most text, slots of a fifth of it or more, the headings just
before them and every other block, however short, of the containers that hold
most of such a slot, but for blocks that are mostly links.  Without a template the slots
are containers: what is around a block, be it a paragraph, a list or a quote.

The templates (a few dozen numbers a host) are written, then join the pages by
host: sent to the tasks up to ``BROADCAST_TOKENS``, beyond that by a shuffle
whose hot hosts the join splits.

Defined results: null or empty html gives an empty text; a page without a url
has the empty host; character references are decoded; white space in a block
becomes one blank; blocks are joined by one line feed in page order; repeated
rows each get a row; no text is capped.
"""

from __future__ import annotations

import bisect
import html as htmllib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdeck.llm.common import saved, ship

SHARE = 0.8
LEAST_PAGES = 5
#: Words of a text run that tells copies of a page apart from others.
LONG_RUN = 12
SLOT_SHARE = 0.2
#: Template tokens (8 bytes each) up to which the templates are broadcast.
BROADCAST_TOKENS = 2_000_000
#: Template tags that may stand between a heading and its text.
HEADING_GAP = 3

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(script|style|noscript|template|svg|iframe|textarea|select|button)\b.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

# HTML elements by their part in the layout.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr td th".split())
SPACED = {"br", "td", "th", "img", "input"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEAD = {"head", "title"}
#: Elements that are blocks of the container around them.
FLOW = set("p li ul ol dl dt dd blockquote pre figure figcaption table caption thead tbody tfoot tr section h1 h2 h3 h4 h5 h6 "
           "header hgroup address center details summary".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
PAGE = {"html", "body"}
BOILERPLATE = set("nav aside footer form dialog menu fieldset".split())
CLOSED_BY_NEXT = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
# Words of class names and ids that mark what is not the article.
BOILERPLATE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification alert sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "disqus respond replies reply share sharing social related recommended subscribe subscription newsletter signup login "
    "popup modal overlay widget toolbar pagination pager skip".split())
# Of these and of names that start with "comment", readers' words,
# which may be longer than the article.
READER_NAMES = {"disqus", "respond", "replies", "reply"}
EDITORS_NAMES = {"commentary", "commentaries", "commentator", "commentators"}


def names_of(attributes: str) -> tuple[set[str], str, bool]:
    """Words of class names, ids and roles; the class text; whether it is marked main."""
    words: set[str] = set()
    shown, main = "", False
    for kind, a, b, c in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if kind.lower() == "class":
            shown = value
        main |= kind.lower() == "role" and value == "main"
        words.update(re.split(r"[^a-z0-9]+", value))
    return words, shown, main


class Run:
    """A text run: its token, block, state and text."""

    __slots__ = ("place", "token", "block", "boilerplate", "article", "link", "text", "heading", "mark", "node")

    def __init__(self, place, token, block, boilerplate, article, link, text, heading=False, mark=0, node=0):
        self.place, self.token, self.block, self.boilerplate = place, token, block, boilerplate
        self.article, self.link, self.text, self.heading, self.mark, self.node = article, link, text, heading, mark, node


class Marks:
    """Containers whose names are of boilerplate, numbered from 1 in page
    order: the one around each, its article, whether its names are of readers'
    words.  And of each article, the container around it and whether it is a main."""

    def __init__(self):
        self.around, self.article, self.readers = [0], [0], [False]
        self.of_article: dict[int, tuple[int, bool]] = {}

    def add(self, around: int, article: int, readers: bool) -> int:
        self.around.append(around)
        self.article.append(article)
        self.readers.append(readers or self.readers[around])
        return len(self.around) - 1

    def chosen(self, good: list[Run]) -> tuple[list[Run], int]:
        """The runs that no name drops, and their article (0: the page has none).

        A name never drops what encloses the page's article, nor most of the
        text of the article (of the page without one).  The page's article is
        the one with the most text; in a named container only a main, or, where
        no article is outside one, an article longer than all text outside.  A
        container of readers' words is spared for most of the text only on a
        page that has nothing else."""
        if not good:
            return [], 0
        n = len(self.around)
        held, total, scope = [0] * n, 0, {}
        for r in good:
            held[r.mark] += len(r.text)
            total += len(r.text)
            scope[r.article] = scope.get(r.article, 0) + len(r.text)
        for m in range(n - 1, 0, -1):
            held[self.around[m]] += held[m]
        free = sum(len(r.text) for r in good if not r.mark and not r.article)
        for lenient in (False, True):
            drops = [False] * n
            for m in range(1, n):
                whole = scope.get(self.article[m], 0) if self.article[m] else total
                most = 2 * held[m] > whole and (lenient or not self.readers[m])
                above = drops[self.around[m]] and self.article[self.around[m]] == self.article[m]
                drops[m] = above or not most
            inside = [r for r in good if r.article and not (self.article[r.mark] and drops[r.mark])]
            mass: dict[int, int] = {}
            for r in inside:
                mass[r.article] = mass.get(r.article, 0) + len(r.text)
            of = {a: self.of_article[a] for a in mass}
            beside = any(not mark for mark, _ in of.values())
            mass = {a: x for a, x in mass.items() if not of[a][0] or of[a][1] or (not beside and x > free)}
            if mass:
                best = max(mass, key=lambda a: (mass[a], -a))
                return [r for r in inside if r.article == best], best
            left = [r for r in good if not drops[r.mark]]
            if left:
                return left, 0
        return [], 0


def _number(role: str) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(role)
    return h - (1 << 64) if h >> 63 else h


class Tree:
    """Elements of a page, numbered from 1 in page order: the one around each,
    whether it is a block of it, and whether it has elements inside; its tag's
    token and place, its article (0: none), and whether it is the whole page."""

    def __init__(self):
        self.around, self.flow, self.inner = [0], [False], [False]
        self.token, self.place, self.article, self.page = [0], [0], [0], [True]

    def add(self, around: int, tag: str, token: int, place: int, article: int) -> int:
        self.around.append(around)
        self.flow.append(tag in FLOW)
        self.inner.append(False)
        self.inner[around] = True
        self.token.append(token)
        self.place.append(place)
        self.article.append(article)
        self.page.append(tag in PAGE)
        return len(self.around) - 1

    def box(self, node: int) -> int:
        """The nearest element, from this one, that is no block of another."""
        while self.flow[node]:
            node = self.around[node]
        return node

    def container(self, node: int) -> int:
        """The container of text right in an element: the nearest element that
        is no block, from the one around it if it has no elements inside."""
        if not self.inner[node]:
            node = self.around[node]
        while self.flow[node]:
            node = self.around[node]
        return node

    def within(self, containers: set[int]) -> list[bool]:
        """Of each element, whether it is one of the containers or in one."""
        out = [0 in containers]
        for i in range(1, len(self.around)):
            out.append(i in containers or out[self.around[i]])
        return out


def parse(page: str | None) -> tuple[list[tuple[int, int]], list[Run], Marks, Tree]:
    """(place, token) of the tags, the text runs, the named containers and the
    elements of a whole page."""
    tags: list[tuple[int, int]] = []
    runs: list[Run] = []
    marks, tree = Marks(), Tree()
    stack: list[tuple[str, bool, int, str, int, int]] = []  # tag, boilerplate, article, path, mark, node
    at = place = block = articles = links = 0
    page = page or ""

    def text(piece: str) -> None:
        nonlocal place
        if not piece or piece.isspace():
            if piece and runs:
                runs.append(Run(place, 0, block, True, 0, False, " "))
            return
        if "&" in piece:
            piece = htmllib.unescape(piece)
        _, boilerplate, article, path, mark, node = stack[-1] if stack else ("", False, 0, "", 0, 0)
        place += 1
        token = _number(f"{path}|{' '.join(piece.split())}")
        heading = bool(stack) and stack[-1][0] in HEADINGS
        runs.append(Run(place, token, block, boilerplate, article, links > 0, piece, heading, mark, node))

    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m.group(2) else links + 1
            if tag in SPACED and runs:
                runs.append(Run(place, 0, block, True, 0, False, " "))
            continue
        block += 1
        links = 0
        _, boilerplate, article, path, mark, node = stack[-1] if stack else ("", False, 0, "", 0, 0)
        if m.group(2):  # an end tag closes its element and what is open in it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    path = stack[i][3]
                    del stack[i:]
                    break
            place += 1
            tags.append((place, _number(f"/{tag}@{path}")))
            continue
        closes = CLOSED_BY_NEXT.get(tag)
        if closes and stack and stack[-1][0] in closes:
            stack.pop()
            _, boilerplate, article, path, mark, node = stack[-1] if stack else ("", False, 0, "", 0, 0)
        words, shown, main = names_of(m.group(4)) if m.group(4) else (set(), "", False)
        if tag in ARTICLE or main:
            if not boilerplate and not article:  # one inside another is part of it
                articles += 1
                article = articles
                marks.of_article[article] = mark, tag == "main" or main
        elif tag not in ("html", "body"):
            boilerplate |= tag in BOILERPLATE or tag in HEAD or (tag == "header" and not article)
            readers = bool(words & READER_NAMES) or any(w.startswith("comment") for w in words)
            named = readers or words & BOILERPLATE_NAMES or ("header" in words and not article)
            readers &= not words & EDITORS_NAMES
            if not boilerplate and named:
                mark = marks.add(mark, article, readers)
        place += 1
        path = f"{path}/{tag}.{shown}"
        token = _number(path)
        tags.append((place, token))
        if tag not in VOID and not m.group(4).rstrip().endswith("/"):
            stack.append((tag, boilerplate, article, path, mark, tree.add(node, tag, token, place, article)))
    text(page[at:])
    return tags, runs, marks, tree


def template_places(tags: list[tuple[int, int]], runs: list[Run], classes: list[list[int]]) -> tuple[list[int], set[int]]:
    """Places of the template's tags in a page and its text tokens: the valid
    classes, larger ones first, nested in one another."""
    first: dict[int, int] = {}
    times: dict[int, int] = {}
    for place, token in [*tags, *((r.place, r.token) for r in runs if r.token)]:
        first.setdefault(token, place)
        times[token] = times.get(token, 0) + 1
    taken: list[list[int]] = []
    texts: set[int] = set()
    is_tag = {token for _, token in tags}
    for tokens in sorted(classes, key=lambda c: (-len(c), c)):
        if any(t not in first for t in tokens):
            continue
        where = [first[t] for t in tokens]
        if len({times[t] for t in tokens}) > 1 or where != sorted(where):
            continue  # out of order: the class is not valid in this page
        if times[tokens[0]] == 1:
            if not all(_nested(where, other) for other in taken):
                continue
            taken.append(where)
        texts.update(t for t in tokens if t not in is_tag)
    tag_places = {place for place, _ in tags}
    return sorted(p for where in taken for p in where if p in tag_places), texts


def _nested(a: list[int], b: list[int]) -> bool:
    """Whether one span lies in one gap of the other, or they are apart."""
    return len({sum(y < x for y in b) for x in a}) == 1 or len({sum(x < y for x in a) for y in b}) == 1


def boxes_of(runs: list[Run], marks: Marks, tree: Tree) -> list[tuple[int, int, bool, int, int]]:
    """(token, token around, whole page, text, text right in it) of a page's
    elements that are no blocks, equal tokens added up: the characters outside
    menus, links and readers' words."""
    n = len(tree.around)
    own = [0] * n
    for r in runs:
        if r.token and not r.boilerplate and not r.link and not marks.readers[r.mark]:
            own[tree.box(r.node)] += len(r.text)
    held = own[:]
    for i in range(n - 1, 0, -1):
        held[tree.around[i]] += held[i]
    out: dict[int, list] = {}
    for i in range(1, n):
        if not tree.flow[i]:
            each = out.setdefault(tree.token[i], [tree.token[tree.box(tree.around[i])], tree.page[i], 0, 0])
            each[2] += held[i]
            each[3] += own[i]
    return [(token, *each) for token, each in out.items() if each[2]]


def region_of(boxes: list[tuple[int, int, bool, int, int]]) -> list[int]:
    """Tokens of a host's region, the deepest first, each next one around it
    and still a region, given the sums of its template's elements."""
    inside: dict[int, list] = {}
    known = {b[0] for b in boxes}
    for b in boxes:
        inside.setdefault(b[1] if b[1] in known else 0, []).append(b)
    chain: list[int] = []
    at, page, text, own = 0, True, sum(b[3] for b in inside.get(0, [])), 0
    while True:
        best = max(inside.get(at, []), key=lambda b: (b[3], -b[0]), default=None)
        if best is None or 2 * best[3] <= text:
            # the text of this element is spread over others: no region
            return chain if 2 * own > text or (at and not page) else []
        if not page and own > text - own - best[3]:
            return chain  # all but the text right in this element is in one: both are the article
        at, page, text, own = best[0], best[2], best[3], best[4]
        if not page:
            chain.insert(0, at)
        elif 2 * own > text:
            return [at]


def region_runs(runs: list[Run], good: list[Run], names: Marks, tree: Tree, region: set[int], marks: list[int],
                dropped: set[int]) -> list[Run]:
    """The runs of a page's article, given the elements of its region."""
    articles = {tree.article[n] for n in region} - {0}
    inside = tree.within(region)
    if articles:
        return names.chosen([r for r in good if r.article in articles])[0]
    kept, article = names.chosen([r for r in good if inside[r.node]])
    if article:
        return kept
    if any(tree.page[n] for n in region):
        at = set(marks)
        others = tree.within({n for n in range(1, len(tree.around)) if not tree.flow[n] and not tree.page[n] and tree.place[n] in at})
        kept = [r for r in kept if not others[r.node]]
    share: dict[int, list[int]] = {}
    for r in kept:
        share.setdefault(r.block, [0, 0])[r.link or r.token in dropped] += len(r.text)
    real = [r.block for r in kept if share[r.block][0] >= share[r.block][1]]
    if not real:
        return []
    kept = [r for r in kept if real[0] <= r.block <= real[-1]]
    around = {tree.box(tree.around[n]) for n in region if not tree.page[n]}
    before = [r for r in good if r.place < kept[0].place and tree.box(r.node) in around and not inside[r.node]
              and r.token not in dropped]
    heads: list[Run] = []
    while before and before[-1].heading:
        heads.insert(0, before.pop())
    return heads + kept


def main_text(page: str | None, classes: list[list[int]] | None, region: list[int] | None = None) -> str:
    """The article of a page, given its host's classes (None: no template) and
    the tokens of its region (``region_of``; None or empty: none)."""
    tags, runs, names, tree = parse(page)
    if not any(r.token for r in runs):
        return ""
    if classes:
        marks, dropped = template_places(tags, runs, classes)
    else:
        marks, dropped = [], set()
    good = [r for r in runs if r.token and not r.boilerplate]
    valid = set(marks)
    for token in region or []:
        found = {n for n in range(1, len(tree.around)) if tree.token[n] == token and tree.place[n] in valid}
        if found:
            return _lines(runs, {r.place for r in region_runs(runs, good, names, tree, found, marks, dropped)})
    return _lines(runs, _without_region(tags, runs, good, names, tree, marks, dropped))


def _without_region(tags, runs, good, names, tree, marks, dropped) -> set[int]:
    """Places of the runs of a page's article by tags, or by the largest slots."""
    chosen, article = names.chosen(good)
    if article:
        return {r.place for r in chosen}
    slots: dict[int, int] = {}
    k = 0
    for r in runs:
        while k < len(marks) and marks[k] < r.place:
            k += 1
        slots[r.place] = k
    good, _ = names.chosen([r for r in good if r.token not in dropped])
    mass: dict[int, int] = {}
    linked: dict[int, list[int]] = {}
    for r in good:
        n = linked.setdefault(r.block, [0, 0])
        n[r.link] += len(r.text)
    good = [r for r in good if linked[r.block][1] <= linked[r.block][0]]
    places = {r.place: tree.container(r.node) for r in good}
    if not marks:
        slots = places
    held: dict[int, dict[int, int]] = {}
    for r in good:
        slot = slots[r.place]
        mass[slot] = mass.get(slot, 0) + len(r.text)
        each = held.setdefault(slot, {})
        each[places[r.place]] = each.get(places[r.place], 0) + len(r.text)
    most = max(mass.values(), default=0)
    kept = {k for k, n in mass.items() if n >= SLOT_SHARE * most}
    # nothing of a container that holds most of a slot is too short to stay
    whole = tree.within({max(each, key=lambda c: (each[c], -c)) for k, each in held.items() if k in kept})
    chosen = {r.place for r in good if slots[r.place] in kept or whole[r.node]}
    # a heading goes with the text that follows it
    tag_places = marks or [place for place, _ in tags]
    edge = {r.place: bisect.bisect_left(tag_places, r.place) for r in good}
    starts = sorted({edge[r.place] for r in good if r.place in chosen})
    for r in good:
        if r.heading and r.place not in chosen:
            i = bisect.bisect_right(starts, edge[r.place])
            if i < len(starts) and starts[i] - edge[r.place] <= HEADING_GAP:
                chosen.add(r.place)
    return chosen


def _lines(runs: list[Run], chosen: set[int]) -> str:
    blocks: dict[int, list[str]] = {}
    for r in runs:
        if r.token and r.place in chosen:
            blocks.setdefault(r.block, []).append(r.text)
        elif not r.token and r.block in blocks:
            blocks[r.block].append(" ")
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)


# ------------------------------------------------------------------- stages --

def host_of(url):
    """Host of a url column, lower case, the empty text without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


BOX = ("token", "around", "page", "text", "own")


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, copy, tokens, times, places, boxes) of every page (host, html):
    distinct tokens, how often each occurs and where first, and ``boxes_of`` it.
    ``copy`` stands for the page's long texts, or for all its tokens if it has none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for host, page in zip(b["host"], b["html"], strict=True):
                tags, runs, marks, tree = parse(page)
                times: dict[int, int] = {}
                first: dict[int, int] = {}
                for place, t in [*tags, *((r.place, r.token) for r in runs if r.token)]:
                    times[t] = times.get(t, 0) + 1
                    first.setdefault(t, place)
                key = sorted({r.token for r in runs if r.token and r.text.count(" ") >= LONG_RUN}) or sorted(times)
                boxes = [dict(zip(BOX, b, strict=True)) for b in boxes_of(runs, marks, tree)]
                out.append((host, _number(repr(key)), list(times), list(times.values()), [first[t] for t in times], boxes))
            yield pd.DataFrame(out, columns=["host", "copy", "tokens", "times", "places", "boxes"])

    return pages.mapInPandas(run, "host string, copy long, tokens array<long>, times array<int>, places array<int>, "
                             "boxes array<struct<token: long, around: long, page: boolean, text: long, own: long>>")


def deduce_templates(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, template, region): the large and frequent classes of each host, each a
    list of its tokens in order of their mean places, and ``region_of`` the
    elements among them."""
    # read twice below, so written once: numbers, a small part of the pages
    one = saved(page_tokens(pages).groupBy("host", "copy").agg(F.min(F.struct("tokens", "times", "places", "boxes")).alias("p")), "tokens")
    each = one.select("host", "copy", F.explode(F.arrays_zip("p.tokens", "p.times", "p.places")).alias("t"))
    counted = each.select("host", "copy", F.col("t.tokens").alias("token"), F.col("t.times").alias("times"), F.col("t.places").alias("place"))
    vectors = counted.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("held"), F.bit_xor(F.xxhash64("copy", "times")).alias("vector"), F.avg("place").alias("place"))
    sizes = one.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    often = vectors.where(F.col("held") >= least_pages).join(sizes, "host").where(
        (F.col("held") >= share * F.col("n")))
    large = often.groupBy("host", "vector", "held").agg(
        F.collect_list(F.struct("place", "token")).alias("members")).where(F.size("members") >= 2)
    templates = (large.select("host", F.transform(F.array_sort("members"), lambda m: m["token"]).alias("c"))
                 .groupBy("host").agg(F.collect_list("c").alias("template")))
    # sums of the elements that enough pages have, so a bounded list a host
    boxes = (one.select("host", F.explode("p.boxes").alias("b")).groupBy("host", "b.token", "b.around", "b.page")
             .agg(F.count(F.lit(1)).alias("held"), F.sum("b.text").alias("text"), F.sum("b.own").alias("own"))
             .where(F.col("held") >= least_pages).join(sizes, "host").where(F.col("held") >= share * F.col("n"))
             .groupBy("host").agg(F.collect_list(F.struct(*BOX)).alias("boxes")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            regions = []
            for classes, held in zip(b["template"], b["boxes"], strict=True):
                known = {int(t) for c in classes for t in c}
                regions.append(region_of([tuple(x[k] for k in BOX) for x in held if x["token"] in known] if held is not None else []))
            yield pd.DataFrame({"host": b["host"], "template": b["template"], "region": regions})

    return templates.join(boxes, "host", "left").mapInPandas(run, "host string, template array<array<long>>, region array<long>")


def extract(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    ship(pages.sparkSession)
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    templates = deduce_templates(p.select("host", "html"), share, least_pages)
    templates = saved(templates, "templates")
    held = templates.agg(F.sum(F.size(F.flatten("template")))).first()[0] or 0
    # small enough to send to every task; otherwise by host, a hot host split by the join
    templates = F.broadcast(templates) if held <= BROADCAST_TOKENS else templates
    joined = p.join(templates, "host", "left").select("page_id", "url", "html", "template", "region")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [main_text(page, [[int(x) for x in c] for c in t] if t is not None else None,
                               [int(x) for x in r] if r is not None else None)
                     for page, t, r in zip(b["html"], b["template"], b["region"], strict=True)]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts})

    # the id travels as text: exact for every long, and a null stays one
    out = joined.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(run, "page_id string, url string, text string")
    return out.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))

"""Main text of web pages, by wrappers inferred from all pages of a host.

A page is a tree of tags and texts. A wrapper is the same kind of tree read as
a union-free regular expression: a child is required, optional (``?``) or
repeated (``+``), and a text is constant or a slot. A page becomes a
wrapper by itself (equal neighbours fold into one repeated child), and two
wrappers are aligned: children are matched in order by tag and class; what only one
side has becomes optional, what one side repeats becomes repeated, and texts that
differ become slots. Aligning is done first within parts of a host, then
between parts, so one host may hold any share of the pages and no task sees
more than one wrapper per part. Attributes are compared without digits, and a
wrapper grows with the kinds of markup of a host, not with its pages.

Each node also sums up what it held: pages, characters, characters in links.
From these the wrapper of a host is cut once: menus, headers, footers, sidebars,
notices, adverts, forms and comments go by their tags, roles and class words;
texts that are constant over many pages and blocks that are mostly links go too.
A class word does not cut a node that holds most of the text, unless the word is
one of comments. Pages of a host fall into layouts, by the kinds of named content they have
(article, main, content words). The content of a layout is the article (or main) node if there is one, or else the
smallest node that holds most of the remaining text. Pages are then read by
the cut wrapper of their host: children are aligned to the wrapper's in order, so
siblings of one key keep apart, and a node is cut for links or a constant text only if
it is mostly links, or has that text, itself. A page of whose remaining text that content
holds little has its area chosen on the page itself; a page that the cut leaves next to nothing of is cut by names only,
and if nothing is left then, by tags and roles only. So only pages whose whole text is in menus, headers, footers and the like are empty.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by two line breaks in page order; blocks
without text are none.

Defined cases: a null or empty html gives an empty text. A null or odd url
counts as a host of its own name (empty). Hosts with a single page have a wrapper of
that page. Broken markup is read as browsers do: a new paragraph ends an open
one, unclosed tags end with their parent; nesting beyond ``DEPTH`` is flattened. Repeated rows give repeated results;
other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import landed

#: Elements nested deeper become children of the one at this depth, with their texts in page order.
DEPTH = 150
#: Pages of a host are aligned in so many parts at first.
PARTS = 64

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea svg iframe object canvas math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
#: Tags whose start ends an open paragraph.
BREAKS_P = set(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
SELF_ENDING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What an implied end may not pass.
SCOPES = {"ul", "ol", "dl", "table", "td", "th", "div", "article", "section", "body", "main", "blockquote"}

BOILERPLATE_TAGS = set("nav footer aside form button select dialog menu head title figcaption".split())
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"}
BOILERPLATE_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup "
    "modal newsletter subscribe subscription signup login share sharing social comment comments reply replies disqus "
    "discussion respond related recommended recommendations trending pagination pager toolbar widget widgets copyright legal "
    "disclaimer skip search form tags byline".split()
)
#: Words of talk about a page, which may be longer than the page.
TALK_WORDS = set("comment comments reply replies disqus discussion respond".split())
CONTENT_WORDS = set("article content post entry story main body text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    """A tag of a page; children are nodes and texts."""

    __slots__ = ("children", "key", "tag")

    def __init__(self, tag: str, key: str):
        self.tag, self.key, self.children = tag, key, []


def key_of(tag: str, attrs: str) -> str:
    """Tag with the words of class, id and role, without digits."""
    words: list[str] = []
    if attrs and "=" in attrs:
        for name, *values in ATTRIBUTE.findall(attrs):
            name = name.lower()
            if name in ("class", "id", "role"):
                value = CAMEL.sub(" ", "".join(values)).lower()
                mark = "@" if name == "role" else "."
                words += [mark + w for w in WORD.findall(value)]
    return tag + "".join(sorted(set(words)))


def parse(html: str) -> Node:
    root = Node("#root", "#root")
    stack, at, n = [root], 0, len(html)
    leaf_of = leaf = None  # the block beyond the depth whose text was read last, and where it went

    def close(names: set[str], stop: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                del stack[depth:]
                return
            if stack[depth].tag in stop:
                return

    while at < n:
        m = TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text and len(stack) - 1 > DEPTH:
            block = next(x for x in reversed(stack) if x.tag not in INLINE)
            if leaf_of is not block or stack[DEPTH].children[-1] is not leaf:
                leaf_of, leaf = block, Node(block.tag, block.key)
                stack[DEPTH].children.append(leaf)
            leaf.children.append(text)
        elif text:
            stack[-1].children.append(text)
        if not m:
            break
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "br":
                stack[-1].children.append(" ")
            elif tag in INLINE:
                close({tag}, SCOPES | BREAKS_P)
            else:
                close({tag}, set() if tag in SCOPES else {"body"})
            continue
        if tag in RAW:
            if not m["attrs"].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else n
            continue
        if tag in BREAKS_P:
            close({"p"}, SCOPES - {"p"})
        if tag in SELF_ENDING:
            close(SELF_ENDING[tag], {"ul", "ol", "dl", "table"})
        node = Node(tag, key_of(tag, m["attrs"]))
        if len(stack) - 1 < DEPTH:
            stack[-1].children.append(node)
        elif tag in VOID:
            stack[DEPTH].children.append(node)
        elif tag not in INLINE:
            leaf_of = None
        if tag not in VOID and not m["attrs"].rstrip().endswith("/"):
            stack.append(node)
    return root


def squeezed(text: str) -> str:
    return " ".join(unescape(text).split())


# A wrapper node is [key, optional, repeated, pages, characters, characters in links, text, children]; text is None
# without own text, a string while it is constant, and SLOT when it differs.
KEY, OPTIONAL, REPEATED, PAGES, CHARS, LINKS, TEXT, CHILDREN = range(8)
SLOT = 0
#: Longer texts count as slots from the start.
CONSTANT_CHARS = 300


def wrapper_of(node: Node, linked: bool = False) -> list:
    """The wrapper of one page: neighbours of one key fold into a repeated child."""
    linked = linked or node.tag == "a"
    own = squeezed(" ".join(c for c in node.children if isinstance(c, str)))
    text = None if not own else own if len(own) <= CONSTANT_CHARS else SLOT
    out = [node.key, False, False, 1, len(own), len(own) if linked else 0, text, []]
    for child in node.children:
        if isinstance(child, str):
            continue
        made = wrapper_of(child, linked)
        out[CHARS] += made[CHARS]
        out[LINKS] += made[LINKS]
        if out[CHILDREN] and out[CHILDREN][-1][KEY] == made[KEY]:
            out[CHILDREN][-1] = merged(out[CHILDREN][-1], made)
            out[CHILDREN][-1][REPEATED] = True
            out[CHILDREN][-1][PAGES] = 1
        else:
            out[CHILDREN].append(made)
    return out


def merged(a: list, b: list) -> list:
    """The wrapper that takes what either takes."""
    if a[TEXT] is None or b[TEXT] is None:
        text = a[TEXT] if b[TEXT] is None else b[TEXT]
    else:
        text = a[TEXT] if a[TEXT] == b[TEXT] else SLOT
    out = [a[KEY], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], a[PAGES] + b[PAGES], a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], text]
    return [*out, aligned(a[CHILDREN], b[CHILDREN])]


def aligned(left: list[list], right: list[list]) -> list[list]:
    """Children matched in order by key; a mismatch is settled as optional by the nearest later match."""
    out: list[list] = []
    places: dict[str, list[int]] = {}
    for j, node in enumerate(right):
        places.setdefault(node[KEY], []).append(j)
    j = 0
    for node in left:
        later = next((x for x in places.get(node[KEY], ()) if x >= j), None)
        if later is None:
            out.append(optional(node))
            continue
        out += [optional(x) for x in right[j:later]]
        out.append(merged(node, right[later]))
        j = later + 1
    return folded(out + [optional(x) for x in right[j:]])


def folded(nodes: list[list]) -> list[list]:
    """Equal neighbours as one repeated child."""
    out: list[list] = []
    for node in nodes:
        if out and out[-1][KEY] == node[KEY]:
            pages = max(out[-1][PAGES], node[PAGES])
            out[-1] = merged(out[-1], node)
            out[-1][REPEATED], out[-1][PAGES] = True, pages
        else:
            out.append(node)
    return out


def optional(node: list) -> list:
    return node if node[OPTIONAL] else [node[KEY], True, *node[2:]]


def expression(node: list) -> str:
    """A wrapper in the notation of regular expressions."""
    text = "" if node[TEXT] is None else "#TEXT " if node[TEXT] == SLOT else json.dumps(node[TEXT]) + " "
    inside = text + " ".join(expression(c) for c in node[CHILDREN])
    mark = {(True, True): "*", (True, False): "?", (False, True): "+"}.get((node[OPTIONAL], node[REPEATED]), "")
    return f"<{node[KEY]}>({inside.strip()}){mark}"


@lru_cache(10_000)
def words_of(key: str) -> tuple[str, set[str], set[str]]:
    parts = re.split(r"(?=[.@])", key)
    return parts[0], {p[1:] for p in parts[1:] if p[0] == "."}, {p[1:] for p in parts[1:] if p[0] == "@"}


#: How a key counts by its names: cut always, cut whatever it holds, or cut unless it holds most of the text.
ALWAYS, SAID_SO, UNLESS_MOST = 3, 2, 1


@lru_cache(10_000)
def named_cut(key: str) -> int:
    tag, words, roles = words_of(key)
    if tag in BOILERPLATE_TAGS - {"form"} or roles & BOILERPLATE_ROLES:
        return ALWAYS
    if tag not in ("body", "html", "article", "main", "p") and words & BOILERPLATE_WORDS:
        return SAID_SO if words & TALK_WORDS else UNLESS_MOST
    return UNLESS_MOST if tag == "form" else 0


def loose(node: list) -> int:
    """Characters of a wrapper node outside what is always cut."""
    if named_cut(node[KEY]) == ALWAYS:
        return 0
    return node[CHARS] - sum(c[CHARS] - loose(c) for c in node[CHILDREN])


def verdict_of(node: list, pages: int, total: int, level: int) -> int:
    """Whether a wrapper node is no content, by its names (CUT) or by what it held (LINKED, SAME)."""
    tag, names = words_of(node[KEY])[0], named_cut(node[KEY])
    if names == ALWAYS:
        return CUT
    if level == ALWAYS:
        return 0
    if names == SAID_SO or (names == UNLESS_MOST and loose(node) <= MOST * total):
        return CUT
    if level == SAID_SO:
        return 0
    if tag in ("ul", "ol", "table", "div", "section", "p") and node[CHARS] and node[LINKS] > LINK_SHARE * node[CHARS]:
        return LINKED
    # the same short text on most of many pages
    constant = not node[CHILDREN] and isinstance(node[TEXT], str) and node[TEXT]
    return SAME if constant and pages >= 5 and node[PAGES] >= 0.6 * pages and tag not in INLINE else 0


#: CUT holds for every node of a key; LINKED and SAME only for a node that is mostly links, or has the text, itself.
CUT, LINKED, SAME = 1, 2, 3
LINK_SHARE = 0.6
#: A node with a boilerplate class that holds more than this share of the text is a layout, not boilerplate.
MOST = 0.7
# A cut node is [key, verdict, constant text or null, children], with the children of the wrapper in their places.
VERDICT, SAID, KIDS = 1, 2, 3


def cut_tree(wrapper: list, level: int = UNLESS_MOST) -> list:
    """What to do at each node of a wrapper; from SAID_SO on by names only, at ALWAYS by tags and roles only."""
    pages, total = wrapper[PAGES], loose(wrapper)

    def visit(node: list) -> list:
        verdict = verdict_of(node, pages, total, level)
        kids = [] if verdict == CUT else [visit(c) for c in node[CHILDREN]]
        return [node[KEY], verdict, node[TEXT] if verdict == SAME else None, kids]

    return visit(wrapper)


def places(keys: list[str], kids: list[list]) -> list[int | None]:
    """For children in order the places of the wrapper's children that take them; those of one key may have several."""
    at, out = 0, []
    for key in keys:
        if not (at < len(kids) and kids[at][KEY] == key):
            later = next((x for x in range(at + 1, len(kids)) if kids[x][KEY] == key), None)
            if later is None:
                out.append(next((x for x in range(min(at, len(kids))) if kids[x][KEY] == key), None))
                continue
            at = later
        out.append(at)
    return out


def weighed(wrapper: list, tree: list) -> list[tuple]:
    """Per node that a cut leaves: place, names, characters left, rank, whether named as content, tag."""
    areas: list[tuple] = []

    def visit(node: list, cut: list, path: str, names: str) -> int:
        """Characters that are left below the node."""
        tag, words, roles = words_of(node[KEY])
        if cut[VERDICT] == CUT or (cut[VERDICT] == LINKED and node[LINKS] > LINK_SHARE * node[CHARS]):
            return 0
        if cut[VERDICT] == SAME and node[TEXT] == cut[SAID]:
            return 0
        left = node[CHARS] - sum(c[CHARS] for c in node[CHILDREN])
        for c, place in zip(node[CHILDREN], places([c[KEY] for c in node[CHILDREN]], cut[KIDS]), strict=True):
            if place is not None:
                left += visit(c, cut[KIDS][place], f"{path}/{place}", f"{names}/{c[KEY]}")
        rank = 2 if tag == "article" else 1 if tag == "main" or "main" in roles else 0
        areas.append((path, names, left, rank, bool(words & CONTENT_WORDS), tag))
        return left

    visit(wrapper, tree, "", wrapper[KEY])
    return areas


def chosen(areas: list[tuple]) -> list[str]:
    """Places where content starts."""
    if not areas:
        return [""]
    total = areas[-1][2]  # the root comes last
    held: dict[str, int] = {}
    for _, names, left, *_ in areas:
        held[names] = held.get(names, 0) + left
    named = [a for a in areas if a[3] and held[a[1]] > 0.2 * total]
    named = named or [a for a in areas if a[4] and a[5] not in INLINE and held[a[1]] > 0.5 * total]
    if named:
        best = max(a[3] for a in named)
        return sorted({a[0] for a in named if a[3] == best})
    holds = [a for a in areas if a[2] >= 0.7 * total and a[5] not in INLINE and a[5] != "p"]
    return [min(holds, key=lambda a: (a[2], -a[0].count("/")), default=("",))[0]]


@lru_cache(10_000)
def kind_of(key: str) -> str:
    tag, words, roles = words_of(key)
    if tag in ("article", "main") or "main" in roles:
        return "article" if tag == "article" else "main"
    return ".".join([tag, *sorted(words & CONTENT_WORDS)]) if tag not in INLINE and words & CONTENT_WORDS else ""


def layout_of(page: Node) -> str:
    """The kinds of named content of a page: its article and main nodes, and tags with content words."""
    kinds: set[str] = set()
    nodes = [page]
    while nodes:
        node = nodes.pop()
        if named_cut(node.key) != ALWAYS:
            kinds.add(kind_of(node.key))
            nodes += [c for c in node.children if not isinstance(c, str)]
    return " ".join(sorted(kinds - {""}))


def cut_wrappers(layouts: dict[str, list]) -> dict:
    """The cut of a host, from all its layouts, and for each layout the places where content starts."""
    wrappers = list(layouts.values())
    whole = wrappers[0]
    for wrapper in wrappers[1:]:
        whole = merged(whole, wrapper)
    tree = cut_tree(whole)
    return {"tree": tree, "content": {name: chosen(weighed(w, tree)) for name, w in layouts.items()}}


def sizes(node: Node, linked: bool = False) -> tuple[int, int]:
    """Characters of a node, and those in links."""
    linked = linked or node.tag == "a"
    own = len(squeezed(" ".join(c for c in node.children if isinstance(c, str))))
    chars, links = own, own if linked else 0
    for child in node.children:
        if not isinstance(child, str):
            more = sizes(child, linked)
            chars, links = chars + more[0], links + more[1]
    return chars, links


def is_cut(node: Node, cut: list) -> bool:
    """Whether a node of a page goes, at its place in a wrapper and by what it holds itself."""
    if cut[VERDICT] == LINKED:
        chars, links = sizes(node)
        return links > LINK_SHARE * chars
    if cut[VERDICT] == SAME:
        return all(isinstance(c, str) for c in node.children) and squeezed(" ".join(node.children)) == cut[SAID]
    return cut[VERDICT] == CUT


def read(page: Node, tree: list, content: list[str]) -> tuple[list[str], int, int, int, bool]:
    """Blocks in content; characters in content, left by the cut, and outside what is always cut; whether article or main gave text."""
    starts = set(content)
    blocks: list[str] = []
    buffer: list[str] = []
    kept = left = gone = 0
    ranked = False

    def flush() -> None:
        text = squeezed("".join(buffer))
        buffer.clear()
        if text:
            blocks.append(text)

    def walk(node: Node, cut: list, path: str, inside: bool, best: bool) -> None:
        nonlocal kept, left, gone, ranked
        if is_cut(node, cut):
            if named_cut(node.key) != ALWAYS:
                gone += loose(wrapper_of(node))
            return
        if path in starts:
            tag, _, roles = words_of(node.key)
            inside, best = True, best or tag in ("article", "main") or "main" in roles
        block = node.tag not in INLINE and node.tag not in VOID
        if block:
            flush()
        found = iter(places([c.key for c in node.children if not isinstance(c, str)], cut[KIDS]))
        for child in node.children:
            if isinstance(child, str):
                chars = len(child.strip())
                left += chars
                if inside:
                    kept += chars
                    ranked = ranked or (best and chars > 0)
                    buffer.append(child)
                continue
            place = next(found)
            if child.tag == "br":
                buffer.append(" ")
            elif child.tag == "hr":
                flush()
            elif place is not None:
                walk(child, cut[KIDS][place], f"{path}/{place}", inside, best)
            else:  # no page of the wrapper has it here: only names can tell
                walk(child, cut_tree(wrapper_of(child), SAID_SO), "-", inside, best)
        if block:
            flush()

    walk(page, tree, "", False, False)
    flush()
    return blocks, kept, left, left + gone, ranked


def blocks_of(page: Node, actions: dict) -> list[str]:
    """Texts of the blocks of a page by the cut and content of its host, or by its own where these do not fit it."""
    tree = actions["tree"]
    blocks, kept, left, whole, ranked = read(page, tree, actions["content"].get(layout_of(page), []))
    if kept >= (0.2 if ranked else 0.5) * left and (left >= 0.1 * whole or (ranked and kept)):
        return blocks
    own = wrapper_of(page)
    if left and kept < (0.2 if ranked else 0.5) * left:  # the content of the host holds little of this page
        blocks, kept, left, whole, ranked = read(page, tree, chosen(weighed(own, tree)))
    if left >= 0.1 * whole or (ranked and kept):
        return blocks
    for level in (SAID_SO, ALWAYS):  # the cut of the host leaves next to nothing
        tree = cut_tree(own, level)
        found = read(page, tree, [""] if left else chosen(weighed(own, tree)))
        if found[0] and found[1] > kept:
            return found[0]
    return blocks


def host_rows(pages: DataFrame, html_col: str, url_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))
    return pages.withColumns({"host": host, "html": F.coalesce(F.col(html_col), F.lit(""))})


def fold_rows(rows: Iterator[tuple[str, str]]) -> dict[str, list]:
    held: dict[str, list] = {}
    for key, wrapper in rows:
        held[key] = merged(held[key], wrapper) if key in held else wrapper
    return held


def infer(pages: DataFrame) -> DataFrame:
    """(host, layout, wrapper): the wrapper of every layout of a host as JSON, from rows (host, html)."""

    def rows_of(held: dict[tuple[str, str], list]) -> pd.DataFrame:
        hosts, layouts = [h for h, _ in held], [x for _, x in held]
        return pd.DataFrame({"host": hosts, "layout": layouts, "wrapper": [json.dumps(w) for w in held.values()]})

    def of_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], list] = {}
        for batch in batches:
            for host, html in zip(batch["host"], batch["html"], strict=True):
                page = parse(html)
                made, key = wrapper_of(page), (host, layout_of(page))
                held[key] = merged(held[key], made) if key in held else made
            if len(held) > 2_000:  # many hosts in one task: hand over what there is
                yield rows_of(held)
                held = {}
        if held:
            yield rows_of(held)

    def together(group: pd.DataFrame) -> pd.DataFrame:
        parts = sorted(group["wrapper"])
        whole = json.loads(parts[0])
        for part in parts[1:]:
            whole = merged(whole, json.loads(part))
        return rows_of({(group["host"].iloc[0], group["layout"].iloc[0]): whole})

    names = "host string, layout string, wrapper string"
    parts = pages.select("host", "html").where("html != ''").mapInPandas(of_pages, names)
    parts = landed(parts, "wrapper_parts").withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)))
    some = parts.groupBy("host", "layout", "part").applyInPandas(together, names)
    return some.groupBy("host", "layout").applyInPandas(together, names)


def cuts(wrappers: DataFrame) -> DataFrame:
    """(host, actions): what to do with the pages of every host, as JSON; layouts are few, as their names are."""

    def cut(group: pd.DataFrame) -> pd.DataFrame:
        layouts = {x: json.loads(w) for x, w in sorted(zip(group["layout"], group["wrapper"], strict=True))}
        return pd.DataFrame({"host": [group["host"].iloc[0]], "actions": [json.dumps(cut_wrappers(layouts))]})

    return wrappers.groupBy("host").applyInPandas(cut, "host string, actions string")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page its id, url and main text."""
    rows = host_rows(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), "html", "url"
    )

    wrappers = landed(cuts(infer(rows)), "wrappers")

    @F.pandas_udf("string")
    def main_text(htmls: pd.Series, actions: pd.Series) -> pd.Series:
        known: dict[str, dict] = {}
        out = []
        for html, text in zip(htmls, actions, strict=True):
            if not html:
                out.append("")
                continue
            if text not in known:
                known[text] = json.loads(text)
            out.append("\n\n".join(blocks_of(parse(html), known[text])))
        return pd.Series(out, dtype=object)

    joined = rows.join(wrappers, "host", "left")
    return joined.select("page_id", "url", main_text("html", "actions").alias("text"))

"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of styles: a node stands for all elements that
are reached by the same chain of tags and classes. For each node the site's pages say

* how varied its presentation is: the entropy of the sequences of styles below it, and
* how varied its content is: one minus the mean entropy of where its texts occur, so a text
  that stands on every page weighs nothing.

A node's importance combines its own presentation with the importance of what is below.
Branches of low importance are removed from each page of the host, as far as the host has
enough pages to tell. What HTML itself or a class name declares to be menu, header, footer,
sidebar, notice, advert, form or comment goes too, also where its text differs from page to
page. What is left inside the page's article (its main part, or else its body) is the text.

Pages of a host with equal content count as one page. Only counts of hashed styles and texts are shuffled; a site's merged tree meets in one task
after aggregation, one row a node.

Edge cases: null and empty pages give an empty text; broken markup is read as far as it
goes, in time proportional to its length; a page without an address belongs to the host "";
repeated rows give repeated results; an empty table gives an empty result; other columns
are carried by ``with_text``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import sized, stored

LEAST_PAGES = 8  # a host with fewer pages has no say
LEAST_IMPORTANCE = 0.2
DECAY = 0.9
BROADCAST_NODES = 20_000  # nodes at most that are sent to all tasks; more are joined
SILENT = frozenset("script style template noscript head title svg math iframe object canvas audio video map".split())
FORMS = frozenset("form button select textarea fieldset datalist option input label".split())
ASIDE = frozenset("nav footer aside menu dialog".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside menu dialog".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SAME_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KEEPS_IN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table")}
_NOISE_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|menu\w*|nav\w*|navbar|breadcrumbs?|header|masthead|topbar|footer\w*|side-?bar\w*|"
    r"aside|widget\w*|cookie\w*|consent|notice\w*|gdpr|alert\w*|popup\w*|modal\w*|overlay|subscri\w+|newsletter\w*|signup|login|"
    r"comments?|comment\w*|respond|replies|disqus\w*|reviews?|share|sharing|social\w*|related(?=$|\s)|related[_-]?(?:posts?|articles?|links?|content|stories|items|news|pages)|recommend\w*|pagination|pager|toolbar|search\w*)(?=$|[\s_-])",
    re.I,
)
_COMMENT = re.compile(r"(?:^|[\s_-])(?:comment|reply|replies)", re.I)
_NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_LOOKED_AT = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("children", "key", "noise", "tag")

    def __init__(self, tag: str, key: int, noise: bool):
        self.tag, self.key, self.noise = tag, key, noise
        self.children: list = []  # nodes and strings


def _key(parent: int, style: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent} {style}")


def _attributes(raw: str) -> dict[str, str]:
    """Attributes one after another, so that no name is looked for inside a value."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw) if raw else ():
        if (name := name.lower()) in _LOOKED_AT:
            found.setdefault(name, value.strip("\"'"))
    return found


class _Scanner:
    """Finds from a place on, and remembers what is not there, so no search runs twice."""

    def __init__(self, text: str):
        self.text, self.none = text, set()

    def find(self, what: str, start: int) -> int:
        if what in self.none:
            return -1
        at = self.text.find(what, start)
        if at < 0:
            self.none.add(what)
        return at

    def tag_end(self, start: int) -> int:
        """Place of the > that ends a tag, outside quotes where they close."""
        end, opened = self.find(">", start), start
        while end >= 0:
            quote = min((p for q in "\"'" if (p := self.text.find("=" + q, opened, end)) >= 0), default=-1)
            if quote < 0:
                return end
            closing = self.find(self.text[quote + 1], quote + 2)
            if closing < 0:
                return end
            opened = closing + 1
            if closing > end:
                end = self.find(">", closing)
        return end


def parsed(page: str) -> _Node:
    """The tree of a page's block elements. Inline elements are transparent."""
    root = _Node("", 0, False)
    stack, scan, at, lower = _Stack(root), _Scanner(page), 0, None
    while True:
        start = scan.find("<", at)
        if start < 0:
            stack[-1].children.append(page[at:])
            break
        if start > at:
            stack[-1].children.append(page[at:start])
        after = page[start + 1 : start + 2]
        if page.startswith("<!--", start):
            end = scan.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        name = _NAME.match(page, start + 1)
        if not name:
            if after in ("!", "?", "/"):
                end = scan.find(">", start)
                at = len(page) if end < 0 else end + 1
            else:
                stack[-1].children.append("<")
                at = start + 1
            continue
        end = scan.tag_end(name.end())
        if end < 0:
            break  # an unfinished tag at the end
        at, tag = end + 1, name[1].lower()
        if after == "/":
            stack.close(tag)
            continue
        raw = page[name.end() : end]
        if tag in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"):
            if raw.endswith("/"):
                continue
            lower = lower or _Scanner(page.lower())
            closing = lower.find(f"</{tag}", at)
            if closing < 0:
                if tag in ("script", "style"):
                    break
                continue
            end = scan.find(">", closing)
            at = len(page) if end < 0 else end + 1
            continue
        if tag in ("br", "wbr"):
            stack[-1].children.append(" " if tag == "br" else "")
            continue
        attributes = _attributes(raw)
        noise = _is_noise(tag, attributes, stack)
        if tag not in BLOCKS and not noise:
            continue
        if tag in BLOCKS and stack[-1].tag == "p":
            stack.close("p")
        for kind in SAME_KIND.get(tag, ()):
            stack.close(kind, KEEPS_IN.get(tag, ()))
        style = " ".join([tag, _DIGITS.sub("", f"{attributes.get('class', '')} {attributes.get('id', '')}")]).strip()
        node = _Node(tag, _key(stack[-1].key, style), noise)
        stack[-1].children.append(node)
        if tag not in VOID and not raw.endswith("/"):
            stack.open(node)
    return root


class _Stack(list):
    """Open elements, and how many of each kind."""

    def __init__(self, root: _Node):
        super().__init__([root])
        self.kinds: dict[str, int] = {}

    def open(self, node: _Node) -> None:
        self.append(node)
        self.kinds[node.tag] = self.kinds.get(node.tag, 0) + 1

    def close(self, tag: str, within: tuple[str, ...] = ()) -> None:
        """Close the innermost open element of a kind, if there is one (inside ``within``)."""
        if not self.kinds.get(tag):
            return
        if within:
            for node in reversed(self):
                if node.tag == tag:
                    break
                if node.tag in within:
                    return
        while self[-1].tag != tag:
            self.kinds[self.pop().tag] -= 1
        self.pop()
        self.kinds[tag] -= 1


def _is_noise(tag: str, attributes: dict[str, str], stack: _Stack) -> bool:
    if tag in SILENT or tag in FORMS or tag in ASIDE:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if tag == "header":  # a page's, not an article's
        return not (stack.kinds.get("article") or stack.kinds.get("main"))
    if tag in ("html", "body", "main"):
        return False
    if attributes.get("role", "").lower() in _NOISE_ROLE:
        return True
    if tag == "article":  # an article that has reviews or adverts for its subject is still one
        return any(_COMMENT.search(attributes[a]) for a in ("class", "id") if a in attributes)
    return any(_NOISE_WORD.search(attributes[a]) for a in ("class", "id") if a in attributes)


def _shown(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def _blocks(node: _Node, removed: frozenset[int] | set[int]) -> Iterator[tuple[_Node, str]]:
    """Texts between block boundaries, in page order, with the element they stand in."""
    parts: list[str] = []
    open_nodes = [(node, iter(node.children))]
    while open_nodes:
        node, children = open_nodes[-1]
        for child in children:
            if isinstance(child, str):
                parts.append(child)
                continue
            if parts:
                yield node, _shown("".join(parts))
                parts = []
            if not child.noise and child.key not in removed:
                open_nodes.append((child, iter(child.children)))
                break
        else:
            if parts:
                yield node, _shown("".join(parts))
                parts = []
            open_nodes.pop()


def _main(root: _Node) -> list[_Node]:
    """The outermost articles, or main parts, or the whole."""
    for wanted in ("article", "main"):
        found, waiting = [], [root]
        while waiting:
            node = waiting.pop()
            if node.noise:
                continue
            if node.tag == wanted:
                found.append(node)
            else:
                waiting.extend(c for c in reversed(node.children) if isinstance(c, _Node))
        if found:
            return found
    return [root]


def main_text(page: str | None, removed=frozenset()) -> str:
    if not page:
        return ""
    blocks = (text for part in _main(parsed(page)) for _, text in _blocks(part, removed))
    return "\n\n".join(b for b in blocks if b)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _observed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What a page shows of each style node: kind 0 its child styles, kind 1 a text. Copies
    of a page have equal shares of one page."""
    for batch in batches:
        rows = []
        for site, page, copies in zip(batch["site"], batch["page"], batch["copies"], strict=True):
            seen, waiting = set(), [(parsed(page), 0)] if page else []
            while waiting:
                node, parent = waiting.pop()
                kids = [c for c in node.children if isinstance(c, _Node)]
                shape = xxhash.xxh3_64_intdigest(np.array([c.key for c in kids], np.uint64).tobytes())
                seen.add((node.key, parent, 0, shape))
                text = _shown("".join(c for c in node.children if isinstance(c, str)))
                if text:
                    seen.add((node.key, parent, 1, xxhash.xxh3_64_intdigest(text.encode())))
                waiting.extend((c, node.key) for c in kids if not c.noise)
            rows.extend((site, *row, 1 / copies) for row in seen)
        if not rows:
            continue
        frame = pd.DataFrame(rows, columns=["site", "node", "parent", "kind", "shown", "share"])
        for name in ("node", "parent", "shown"):
            frame[name] = frame[name].astype("uint64").to_numpy().view(np.int64)
        yield frame


def _judged(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """Low branches of a site's merged tree, given one row a node."""
    site = key[0]
    rows = {r.node: r for r in nodes.itertuples(index=False)}
    below: dict[int, list[int]] = {}
    for r in rows.values():
        if r.node != r.parent:
            below.setdefault(r.parent, []).append(r.node)
    order, waiting = [], [0]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(below.get(node, ()))
    importance: dict[int, float] = {}
    for node in reversed(order):
        own = rows.get(node)
        kids = below.get(node, [])
        parts, weights = [], []
        if own is not None and own.texts > 0:
            parts.append(own.content)
            weights.append(own.texts)
        for kid in kids:
            parts.append(importance[kid])
            weights.append(rows[kid].seen)
        if not parts:  # nothing to read below
            importance[node] = 0.0
            continue
        inner = float(np.average(parts, weights=weights))
        decay = DECAY ** max(1, own.shapes if own is not None else 1)
        presentation = own.presentation if own is not None and kids else inner
        # The varied part of either kind carries the branch.
        importance[node] = max(inner, (1 - decay) * presentation + decay * inner)
    low, waiting = [], [0]
    while waiting:
        node = waiting.pop()
        own = rows.get(node)
        if node and own is not None and own.seen >= LEAST_PAGES and importance[node] < LEAST_IMPORTANCE:
            low.append(node)
            continue
        waiting.extend(below.get(node, ()))
    return pd.DataFrame({"site": pd.Series([site] * len(low), dtype=object), "node": np.array(low, np.int64)})


def low_branches(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(site, node): the branches to remove from each page of a site."""
    rows = pages.select(host(F.col(url)).alias("site"), F.col(page).alias("page"))
    rows = rows.select("site", "page", F.xxhash64("page").alias("h1"), F.xxhash64(F.lit(1), "page").alias("h2"))
    contents = stored(rows.groupBy("site", "h1", "h2").agg(F.count("*").alias("copies")), "contents")
    rows = rows.join(sized(contents.where("copies > 1")), ["site", "h1", "h2"], "left")
    rows = rows.select("site", "page", F.coalesce("copies", F.lit(1)).alias("copies"))
    counts = rows.mapInPandas(_observed, "site string, node long, parent long, kind int, shown long, share double")
    # The shares of a content's copies add up to one, so the sum is its number of distinct pages.
    counts = counts.groupBy("site", "node", "parent", "kind", "shown").agg(F.round(F.sum("share")).cast("long").alias("k"))
    sites = contents.groupBy("site").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    k, kind = F.col("k"), F.col("kind")
    nodes = counts.groupBy("site", "node", "parent").agg(
        F.sum(F.when(kind == 0, k).otherwise(0)).alias("seen"),
        F.sum(F.when(kind == 0, 1).otherwise(0)).alias("shapes"),
        F.sum(F.when(kind == 1, k).otherwise(0)).alias("texts"),
        F.sum(F.when(kind == 0, k * F.log(k)).otherwise(0.0)).alias("shape_sum"),
        F.sum(F.when(kind == 1, k * F.log(k)).otherwise(0.0)).alias("text_sum"),
    )
    spread = F.log(F.greatest(F.col("seen"), F.lit(2)))
    nodes = nodes.join(sites, "site").select(
        "site", "node", "parent", "pages", "seen", "shapes", "texts",
        ((spread - F.col("shape_sum") / F.greatest("seen", F.lit(1))) / spread).alias("presentation"),
        F.when(F.col("texts") > 0, 1 - F.col("text_sum") / F.col("texts") / F.log(F.greatest("pages", F.lit(2)))).otherwise(0.0).alias("content"),
    )
    return nodes.groupBy("site").applyInPandas(_judged, "site string, node long")


def _texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, removed in batches:
        nodes = [frozenset() if r is None else {int(x) & (2**64 - 1) for x in r} for r in removed]
        yield pd.Series([main_text(p, n) for p, n in zip(pages, nodes, strict=True)], dtype=object)


def with_text(pages: DataFrame, url: str = "url", page: str = "html", name: str = "text") -> DataFrame:
    """The rows with their main text as column ``name`` (which replaces one of that name)."""
    low = stored(low_branches(pages, url, page), "branches")
    few = low.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    removed = low.groupBy("site").agg(F.collect_set("node").alias("removed"))
    rows = pages.select(F.struct("*").alias("row"), host(F.col(url)).alias("site"))
    joined = rows.join(F.broadcast(removed) if few else removed, "site", "left")
    text = F.pandas_udf(_texts, "string")(F.col("row")[page], F.col("removed"))
    return joined.select(*(F.col("row")[c].alias(c) for c in pages.columns if c != name), text.alias(name))


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: id, address, main text and its length in code points."""
    rows = with_text(pages.select(page_id, url, page), url, page)
    return rows.select(page_id, url, "text", F.char_length("text").cast("long").alias("n_chars"))

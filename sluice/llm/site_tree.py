"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree.  A node is an element's place
below its parent's node: its tag, its presentation (class, id, role; digits
stand for each other) and whether it holds further blocks.  After Yi, Liu and
Li (2003) a node has a content importance, one less the mean entropy over host's
pages of the different texts shown there, and a presentation importance, the
entropy of the sequences of its children.  Text inside links counts as none
outside an article.  What is left is the node's information.

The trunk is the chain of nodes that have others below them and hold over half
of the host's information each; it ends in the node that holds the articles.  A branch beside it weighs
as much as its information against that node's.  ``node_importance`` joins the
three: uniqueness * unlinked share * (information and presentation of the branch).

A block's tag, class, id and role, and whether it lies in an article or main
element where the page has one, are a prior of 0 or 1.  The tree's word
against it grows with the pages that show the node: ``WEIGHT * n / (n + PRIOR_PAGES)``;
one rule at every size of a host.  Names of trunk nodes say nothing.  Forms,
scripts, hidden elements and reader comments go always: what readers write is
as informative as an article.

Pages are parsed once; all else is Spark SQL over the parsed pages.  A host's
rows are summed with partial aggregation and joined by (host, node); the two
joins by host are salted.  Nodes below ``DEPTH`` levels count as that level's.

Null html gives an empty text, a null or odd url the empty host.  Unclosed
elements end with their parent or, for paragraphs and list items, with the
next one; a page cut short keeps what is there.  Repeated rows keep their
rows, but pages of equal text count once in the tree; empty tables give empty
results.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_rows, stored

#: What the tree may say against the prior where many pages show a node.
WEIGHT = 0.6
#: Pages of a node at which the tree has half of its weight.
PRIOR_PAGES = 1
#: Share of the presentation's entropy in a branch's weight.
PRESENTATION = 0.2
#: A block is kept from this on.
KEEP = 0.5
DEPTH = 512
SALTS = 16

_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*+>|"
    rf"<(?P<raw>script|style|textarea|title|noscript|iframe|template|svg|math|select|object)(?=[\s/>]){_QUOTED}>.*?(?:</(?P=raw)\s*+>|\Z)|"
    rf"<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<rest>{_QUOTED})>|"
    r"</?[a-z][^>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: Elements that never hold article text.
_NEVER = frozenset("form button head dialog fieldset datalist audio video canvas".split())
#: Elements with other text as a rule; header only outside an article.
_NOISE = frozenset("nav footer aside menu".split())
_MAIN = frozenset(("article", "main"))
_NOISE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side-?bar|widgets?|menu|nav\w*|breadcrumbs?|footer|masthead|cookies?|consent|notices?|alert|pop-?up|modal|overlay|newsletter|subscribe|sign-?up|login|search|share|sharing|social|related|recommend\w*|comments?|replies|reply|respond|disqus|toolbar|pagination|pager|skip|contentinfo|complementary|navigation)(?:$|[\s_-])",
    re.I,
)
_COMMENT_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|respond|disqus)(?:$|[\s_-])", re.I)
_HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:header|topbar)(?:$|[\s_-])", re.I)
#: Tags that end an open element of the given kind.
_CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
_BREAKS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split())


def host_of(url: str) -> Column:
    """The host of a url column, lower-cased; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


class Page:
    """A page's blocks and elements, in order.

    ``blocks`` has (text, node, characters but white space, those in links, nodes with a name or tag against the
    block, whether inside an article, whether the first such text in its node); ``nodes`` by node its line from the root and the sequences of its children.
    A name says nothing against an outermost article or main element, or one without such a name, nor against what
    contains it: comments and teasers are articles, too.
    """

    def __init__(self, source: str | None) -> None:
        self._found: list[tuple[str, int, int, int, tuple[int, ...], bool]] = []
        self._elements: list[tuple[int, str, int]] = [(-1, "", 0)]  # parent, signature, depth
        self._children: list[list[str]] = [[]]
        self._names: list[int | None] = []  # element of each name that counts
        self._comments: set[int] = set()  # places in _names of reader comments
        self._tags: set[int] = set()  # and of elements whose tag is against them
        # tag, element, never shown, names above, inside an article
        self._stack: list[tuple[str, int, bool, tuple[int, ...], bool]] = [("", 0, False, (), False)]
        self._text: list[str] = []
        self._linked: list[str] = []
        self._link = False
        at, source = 0, source or ""
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            if m["tag"]:
                self._tag(m["tag"].lower(), bool(m["end"]), m["rest"])
        self._add(source[at:])
        self._flush()
        ids = [ROOT]
        lines: list[tuple[int, ...]] = [(ROOT,)]
        self.nodes: dict[int, tuple[tuple[int, ...], set[str]]] = {ROOT: ((ROOT,), {" ".join(self._children[0])})}
        for (parent, signature, _), tags in zip(self._elements[1:], self._children[1:], strict=True):
            node = hash_of(f"{ids[parent]}/{signature}{'+' if tags else ''}")
            ids.append(node)
            lines.append((*lines[parent], node))
            self.nodes.setdefault(node, (lines[-1], set()))[1].add(" ".join(tags))
        self.blocks: list[tuple[str, int, int, int, list[int], bool, bool]] = []
        shown: set[tuple[int, str]] = set()
        for text, element, size, linked, under, inside in self._found:
            counting = [k for k in under if self._names[k] is not None]
            if self._comments.isdisjoint(counting):
                before = len(shown)
                shown.add((ids[element], re.sub("[0-9]+", "#", text.lower())))
                self.blocks.append((text, ids[element], size, linked, [ids[self._names[k]] for k in counting], inside, len(shown) > before))

    def _add(self, text: str) -> None:
        self._text.append(text)
        if self._link:
            self._linked.append(text)

    def _flush(self) -> None:
        words = _words(self._text)
        linked = _words(self._linked)
        self._text.clear()
        self._linked.clear()
        _, element, never, under, inside = self._stack[-1]
        if words and not never:
            self._found.append((" ".join(words), element, sum(map(len, words)), sum(map(len, linked)), under, inside))

    def _tag(self, tag: str, end: bool, rest: str) -> None:
        if tag in _INLINE:
            if tag == "a":
                self._link = not end
            return
        if tag in _VOID:
            if tag == "hr":
                self._flush()
            else:
                self._add(" ")
            return
        self._flush()
        stack = self._stack
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            return
        while len(stack) > 1 and (stack[-1][0] in _CLOSES.get(tag, ()) or stack[-1][0] == "p" and tag in _BREAKS_P):
            stack.pop()
        _, parent, never, under, inside = stack[-1]
        names = ""
        if rest:
            for key, value in _ATTRIBUTE.findall(rest):
                key, value = key.lower(), value.strip("\"'")
                if key in ("class", "id", "role"):
                    names += " " + value
                else:
                    never |= key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I) is not None
        never = never or tag in _NEVER
        noise = tag in _NOISE or tag == "header" and not inside
        named = bool(names and tag not in ("body", "html") and (_NOISE_NAME.search(names) or not inside and _HEADER_NAME.search(names)))
        element = parent
        if self._elements[parent][2] < DEPTH:
            self._children[parent].append(tag)
            element = len(self._elements)
            self._elements.append((parent, tag + re.sub(r"\d+", "#", ".".join(names.split()) and "." + ".".join(sorted(names.split()))), self._elements[parent][2] + 1))
            self._children.append([])
        if tag in _MAIN and (not inside or not named):
            for k in under:
                if k not in self._tags:
                    self._names[k] = None
        if noise or named and tag not in _MAIN:
            if noise:
                self._tags.add(len(self._names))
            if _COMMENT_NAME.search(names):
                self._comments.add(len(self._names))
            under = (*under, len(self._names))
            self._names.append(element)
        stack.append((tag, element, never, under, inside or tag in _MAIN))


def _words(pieces: list[str]) -> list[str]:
    text = "".join(pieces)
    return (entities.unescape(text) if "&" in text else text).split()


def hash_of(text: str) -> int:
    import xxhash

    value = xxhash.xxh3_64_intdigest(text.encode(errors="surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


ROOT = 0
BLOCK = "struct<text: string, node: bigint, size: bigint, linked: bigint, names: array<bigint>, inside: boolean, first: boolean>"
NODE = "struct<node: bigint, line: array<bigint>, shapes: array<bigint>>"


def parsed(pages: DataFrame) -> DataFrame:
    """Each row of ``pages`` as blocks and nodes, with hashes of its whole text and of its set of nodes, numbered; written once."""

    def make(ids: list, urls: list, hosts: list, sources: list) -> Iterator[tuple]:
        for page_id, url, host, source in zip(ids, urls, hosts, sources, strict=True):
            page = Page(source)
            whole = hash_of("\n".join(b[0] for b in page.blocks))
            nodes = [(node, line, [hash_of(s) for s in sorted(shapes)]) for node, (line, shapes) in page.nodes.items()]
            yield page_id, url, host, whole, hash_of(repr(sorted(page.nodes))), page.blocks, nodes

    schema = f"page_id bigint, url string, host string, whole bigint, kind bigint, blocks array<{BLOCK}>, nodes array<{NODE}>"
    keyed = pages.select("page_id", "url", host_of("url").alias("host"), "html")
    rows = map_rows(keyed, ["page_id", "url", "host", "html"], make, schema)
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "site-pages")


def _by_host(left: DataFrame, right: DataFrame, salt: Column, how: str = "inner") -> DataFrame:
    """Join by host with one row of ``right`` a host, which is repeated for each salt, so that a hot host's rows spread."""
    many = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("__salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(many, ["host", "__salt"], how).drop("__salt")


def _facts(seen: DataFrame) -> DataFrame:
    """(host, node, line, n, unique, plain, info, style) of the nodes of each host's tree, from all its different pages.

    ``n`` pages show the node; ``unique`` is one less the mean of log c / log m over its different texts, each shown
    by c of the host's m pages (digits and case aside); ``plain`` the share of characters outside links; ``info`` the
    characters times both; ``style`` the entropy, to base m, of the sequences of its children.
    """
    def entry(node: Column, what: int, feature: Column, size: Column, linked: Column) -> Column:
        return F.struct(node.alias("node"), F.lit(what).alias("what"), feature.alias("feature"), size.cast("bigint").alias("size"), linked.cast("bigint").alias("linked"))

    block = F.transform(F.filter("blocks", lambda b: b["first"]), lambda b: entry(b["node"], 0, F.xxhash64(F.regexp_replace(F.lower(b["text"]), "[0-9]+", "#")), b["size"], F.when(b["inside"], F.lit(0)).otherwise(b["linked"])))
    # a node's first shape on a page counts the page, as its size
    shape = F.flatten(F.transform("nodes", lambda n: F.transform(n["shapes"], lambda s, i: entry(n["node"], 1, s, (i == 0).cast("int"), F.lit(0)))))
    # a page that repeats another one's text gives no further rows
    first = seen.groupBy("host", "whole").agg(F.min("row").alias("row")).select("row")
    rows = seen.select("row", "host", F.concat(block, shape).alias("all")).join(first, "row", "left_semi").select("host", F.inline("all"))
    counts = rows.groupBy("host", "node", "what", "feature").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("size"), F.sum("linked").alias("linked"))

    def of(what: int, value: Column) -> Column:
        return F.sum(F.when(F.col("what") == what, value))

    lines = seen.select("host", F.inline("nodes")).groupBy("host", "node").agg(F.first("line").alias("line"))
    summed = counts.groupBy("host", "node").agg(
        of(1, F.col("size")).alias("n"), of(0, F.log("c")).alias("logs"), of(0, F.lit(1)).alias("texts"),
        of(0, F.col("size")).alias("size"), of(0, F.col("linked")).alias("linked"),
        of(1, F.col("c")).alias("s"), of(1, F.col("c") * F.log("c")).alias("slogs"))
    summed = stored(summed.join(lines, ["host", "node"]), "site-counts")
    pages = summed.where(F.col("node") == ROOT).select("host", F.col("n").alias("m"))
    logm = F.when(F.col("m") > 1, F.log("m"))
    facts = _by_host(summed, pages, F.col("node")).select(
        "host", "node", "line", "n", "size",
        (1 - F.coalesce(F.col("logs") / F.col("texts") / logm, F.lit(0.0))).alias("unique"),
        F.greatest(F.lit(0.0), 1 - F.coalesce(F.col("linked") / F.col("size"), F.lit(0.0))).alias("plain"),
        F.greatest(F.lit(0.0), F.coalesce((F.log("s") - F.col("slogs") / F.col("s")) / logm, F.lit(0.0))).alias("style"))
    info = F.coalesce(F.col("size") * F.col("unique") * F.col("plain"), F.lit(0.0))
    return stored(facts.withColumn("info", info), "site-facts")


def _trunks(masses: DataFrame) -> DataFrame:
    """(host, trunk, bulk): each host's nodes that hold over half of its information with others, from the root down, and the last one's information."""
    total = masses.where(F.col("node") == ROOT).select("host", F.col("mass").alias("total"))
    most = _by_host(masses, total, F.col("node")).where("mass > total / 2 AND inner")
    chain = most.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "mass"))).alias("chain"))  # at most DEPTH + 1
    return chain.select("host", F.col("chain.node").alias("trunk"), F.element_at("chain", -1)["mass"].alias("bulk"))


def node_importance(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, node, n, importance) of all nodes of the pages ``seen`` (see ``parsed``), and the trunks of their hosts."""
    facts = _facts(seen)
    masses = facts.select("host", F.posexplode("line").alias("depth", "node"), "info", F.size("line").alias("size"))
    inner = (F.col("depth") == 0) | (F.col("depth") < F.col("size") - 1) & (F.col("info") > 0)
    masses = masses.groupBy("host", "node").agg(F.sum("info").alias("mass"), F.max("depth").alias("depth"), F.max(inner).alias("inner"))
    masses = stored(masses, "site-masses")
    trunks = stored(_trunks(masses), "site-trunks")
    placed = _by_host(facts, trunks, F.col("node"), "left")
    main = F.element_at("trunk", -1)
    beside = F.try_element_at(F.array_except("line", "trunk"), F.lit(1))
    # the node of the articles for what lies in it, else the branch off the trunk, else (text in the trunk itself) the node
    placed = placed.withColumn("unit", F.when(F.array_contains("line", main), main).otherwise(F.coalesce(beside, "node")))
    placed = placed.withColumn("alone", F.coalesce(F.array_contains("trunk", F.col("unit")) & (F.col("unit") != main), F.lit(False)))
    units = facts.select("host", F.col("node").alias("unit"), F.col("style").alias("unit_style")).join(masses.select("host", F.col("node").alias("unit"), "mass"), ["host", "unit"])
    # most nodes of a host share a few units: each unit is joined once a salt
    units = units.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = placed.withColumn("__salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(units, ["host", "unit", "__salt"])
    share = F.when(F.col("bulk") > 0, F.least(F.lit(1.0), F.when(F.col("alone"), F.col("info")).otherwise(F.col("mass")) / F.col("bulk"))).otherwise(0.0)
    branch = (1 - PRESENTATION) * share + PRESENTATION * F.least(F.lit(1.0), "unit_style")
    return joined.select("host", "node", "n", (F.col("unique") * F.col("plain") * branch).alias("importance")), trunks


def extract(pages: DataFrame, weight: float = WEIGHT, names: bool = True) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points of the text).

    ``weight`` 0 leaves the tree out; without ``names`` the prior is 1 everywhere, and the tree decides alone.
    """
    seen = parsed(pages)
    importance, trunks = node_importance(seen)
    # pages with the same nodes share one row of rules
    kinds = seen.groupBy("host", "kind").agg(F.first("nodes.node").alias("nodes"))
    of_kind = kinds.select("host", "kind", F.explode("nodes").alias("node")).join(importance, ["host", "node"])
    share = F.lit(float(weight)) * F.col("n") / (F.col("n") + PRIOR_PAGES)
    of_kind = of_kind.groupBy("host", "kind").agg(F.map_from_entries(F.collect_list(F.struct("node", F.struct(share.alias("w"), "importance")))).alias("rules"))
    rules = stored(_by_host(of_kind, trunks.select("host", "trunk"), F.col("kind"), "left"), "site-rules")
    rules = rules.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = seen.drop("nodes").withColumn("__salt", F.pmod(F.xxhash64("page_id", "whole"), F.lit(SALTS)).cast("int"))
    joined = salted.join(rules, ["host", "kind", "__salt"], "left")

    def clean(b: Column) -> Column:
        return F.size(F.array_except(b["names"], F.coalesce("trunk", F.array().cast("array<bigint>")))) == 0

    article = F.exists("blocks", lambda b: b["inside"] & clean(b))

    def kept(b: Column) -> Column:
        prior = (clean(b) & (b["inside"] | ~F.col("article"))).cast("double") if names else F.lit(1.0)
        rule = F.try_element_at("rules", b["node"])
        return F.coalesce(rule["w"] * rule["importance"] + (1 - rule["w"]) * prior, prior) >= KEEP

    text = F.array_join(F.transform(F.filter("blocks", kept), lambda b: b["text"]), "\n\n")
    return joined.withColumn("article", article).select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))

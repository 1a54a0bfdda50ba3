"""Main text of web pages by wrapper induction.

A page is parsed into a tree of block elements; siblings alike are folded into one. Pages of a
host are aligned by simple tree matching and merged into the host's wrapper, a tree of slots.
All different pages then vote, per slot, with the hashes and sizes of the texts they hold there: a text that
most of the host's different pages have in one slot is template, what varies is content. So a constant
cell is told from the varying one beside it, though both are folded into one slot.

The slot that holds the article is found from the same votes: from the top, the way goes down to the slot
below that has most of the running text (text outside links), as long as that slot has blocks of its own. Slots reached by
the same elements on all hosts share their evidence, so that a host with one page is judged by what its
layout holds elsewhere. Elements and names only decide what is left open: they hide blocks inside and beside the
article, but none that holds most of the text.

Merging and voting are grouped by host after a first grouping that shrinks equal rows, so a
host may have any share of the pages.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.llm.common import hinted
from accessaudit.session import fresh_folder, written

# fixed values: elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
SPACE = frozenset("br img".split())
#: A new element of this kind ends an open one of these, unless one of those is opened in between.
ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr", "table"),
    "td": ("td th", "table"),
    "th": ("td th", "table"),
    "tbody": ("tbody thead tfoot", "table"),
    "tfoot": ("tbody thead tfoot", "table"),
    "option": ("option", "select datalist"),
}
ENDS = {tag: (frozenset(ends.split()), frozenset(bounds.split())) for tag, (ends, bounds) in ENDS.items()}
ENDS_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: Their texts are never read.
SILENT = frozenset(
    "head script style title textarea noscript template iframe object svg math canvas audio video button select input "
    "noembed noframes xmp datalist".split()
)
#: Elements beside an article.
ASIDE = frozenset("nav footer aside menu dialog".split())
#: Words in class names, ids and roles of what is not the article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar aside complementary footer contentinfo masthead cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related "
    "recommended comment comments respond reply replies disqus widget pagination pager toolbar skip copyright form".split()
)
HEADERS = frozenset("header topbar".split())
#: Words that go with those above; a name that holds any other word ("share-price-analysis", "has-sidebar") says nothing.
AROUND = frozenset(
    "site page main top bottom left right box area block list wrapper wrap container section bar panel inner outer links link "
    "button buttons item items text title message slot unit region module group thread body post posts article articles stories "
    "icon icons primary secondary global inline floating sticky google media".split()
)
ROOTS = frozenset(["article", "main"])

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
OPEN_END = re.compile(r"<!--(?:.*)\Z|<!\[CDATA\[.*\Z|<[!?][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")

CONSTANT, LEAST_PAGES = 0.8, 5
LINKS = 0.6
#: Share of the running text that leads on to a slot, and that no name can hide.
MOST = 0.6
#: A slot beside it with this much of its text, on the pages that have both, may belong to the article.
BESIDE = 0.4
#: Different pages that the evidence of all hosts weighs beside a host's own.
SHARED = 5
HEADINGS = frozenset("h1 h2 h3 hgroup".split())


class Node:
    __slots__ = ("tag", "sign", "children", "items", "slot", "links")

    def __init__(self, tag: str, sign: str):
        self.tag, self.sign = tag, sign
        self.children: list[Node] = []
        self.items: list = []  # texts and children in order
        self.slot, self.links = 0, 0


def _sign(tag: str, attributes: str) -> str:
    """Element, names and role, without numbers; `!` marks what a reader never sees as part of the article."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag
    names = []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            names.append("!")
        elif name in ("class", "id", "role"):
            names += DIGITS.sub("", value).split()
    return ".".join([tag, *sorted(set(names))]) if names else tag


def parse(page: str) -> Node:
    """The tree of block elements; texts of inline elements belong to the block around them."""
    root = Node("", "")
    stack, at, links = [root], 0, 0
    opened: Counter = Counter()
    size, last = len(page), page.rfind(">")

    def close(depth: int) -> None:
        for node in stack[depth:]:
            opened[node.tag] -= 1
        del stack[depth:]

    while at < size:
        # past the last > only comments and the like can start
        found = (TOKEN if at <= last else OPEN_END).search(page, at)
        upto = found.start() if found else size
        if upto > at:
            text = page[at:upto]
            if "&" in text:
                text = html.unescape(text)
            stack[-1].items.append(text)
            if links:
                stack[-1].links += len(text)
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5] if found.re is TOKEN else None
        if not tag:
            if found[0].startswith("<![CDATA["):
                stack[-1].items.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in SPACE:
                stack[-1].items.append(" ")
            if opened[tag] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(depth)
            continue
        attributes = found[3] or found[6] or ""
        sign = _sign(tag, attributes)
        if tag in INLINE and (sign == tag or not (_silent(sign) or _named(sign))):
            if tag == "a":
                links += 1
            if tag in SPACE:
                stack[-1].items.append(" ")
            continue
        if tag in ENDS_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
            links = 0
        if tag in ENDS and any(opened[t] > 0 for t in ENDS[tag][0]):
            ends, bounds = ENDS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    close(depth)
                    break
                if stack[depth].tag in bounds:
                    break
        node = Node(tag, sign)
        stack[-1].children.append(node)
        stack[-1].items.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in ENDS_P:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        stack.append(node)
        opened[tag] += 1
    return root


def _silent(sign: str) -> bool:
    tag, *names = sign.split(".")
    return tag in SILENT or "!" in names


def _named(sign: str, inside: bool = False) -> bool:
    """Whether names say that an element is no part of an article; `inside` one, a header is."""
    tag, *names = sign.split(".")
    if tag in ("", "html", "body"):
        return False
    if not inside and tag == "header" or tag == "form":
        return True
    wanted = BOILERPLATE if inside or tag in ROOTS else BOILERPLATE | HEADERS
    said = []
    for name in names:
        words = set(NAME.findall(name))
        said.append(bool(words & wanted) and words <= wanted | AROUND)
    return bool(said) and all(said) if tag in ROOTS else any(said)


Tree = tuple[list[str], list[int]]  # signs and parents of folded nodes, level by level from the root


def fold(root: Node) -> Tree:
    """The folded tree of a page: siblings alike become one, in the order of their first. Sets their numbers as slots."""
    signs, parents, groups = [root.sign], [-1], [[root]]
    for at, alike in enumerate(groups):  # grows on the way
        below: dict[str, list[Node]] = {}
        for node in alike:
            node.slot = at
            for child in node.children:
                below.setdefault(child.sign, []).append(child)
        signs += below
        parents += [at] * len(below)
        groups += below.values()
    return signs, parents


def _below(tree: Tree) -> list[list[int]]:
    below: list[list[int]] = [[] for _ in tree[0]]
    for node, parent in enumerate(tree[1]):
        if parent >= 0:
            below[parent].append(node)
    return below


def _heaviest(matches: list[tuple]) -> tuple[int, list[tuple]]:
    """The heaviest chain of (i, j, weight) that rises in i and j, and its weight; matches come ordered by i."""
    if all(x[0] < y[0] and x[1] < y[1] for x, y in pairwise(matches)):
        return sum(m[2] for m in matches), matches
    places = {j: n for n, j in enumerate(sorted({m[1] for m in matches}), 1)}
    best: list = [(0, -1)] * (len(places) + 1)  # Fenwick tree of (weight, last match)
    before = []
    order = sorted(range(len(matches)), key=lambda n: (matches[n][0], -matches[n][1]))
    for n in order:
        at, found = places[matches[n][1]] - 1, (0, -1)
        while at > 0:
            found = max(found, best[at])
            at &= at - 1
        before.append((n, found[1]))
        at, own = places[matches[n][1]], (found[0] + matches[n][2], n)
        while at < len(best):
            best[at] = max(best[at], own)
            at += at & -at
    weight, n = max(best)
    back, chain = dict(before), []
    while n >= 0:
        chain.append(matches[n])
        n = back[n]
    return weight, chain[::-1]


def matched(a: Tree, b: Tree) -> tuple[int, dict[int, list[tuple[int, int]]]]:
    """Simple tree matching: the number of nodes that two trees share in order, and per node of `a` the pairs of children."""
    if a[0][0] != b[0][0]:
        return 0, {}
    left, right = _below(a), _below(b)
    pairs, tries = [(0, 0)], []
    for x, y in pairs:  # grows on the way
        named: dict[str, list[int]] = {}
        for j in right[y]:
            named.setdefault(b[0][j], []).append(j)
        first = len(pairs)
        pairs += [(i, j) for i in left[x] for j in named.get(a[0][i], ())]
        tries.append(range(first, len(pairs)))
    weights, chains = [0] * len(pairs), [None] * len(pairs)
    for n in range(len(pairs) - 1, -1, -1):
        weight, chains[n] = _heaviest([(*pairs[m], weights[m], m) for m in tries[n]])
        weights[n] = weight + 1
    partners, todo = {}, [0]
    while todo:
        n = todo.pop()
        partners[pairs[n][0]] = [(i, j) for i, j, *_ in chains[n]]
        todo += [m for *_, m in chains[n]]
    return weights[0], partners


def merge(a: Tree, b: Tree) -> Tree:
    """One tree with the nodes of both."""
    if a == b:
        return a
    partners, left, right = matched(a, b)[1], _below(a), _below(b)
    signs, parents, made = [a[0][0]], [-1], [(0, 0)]
    for at, (x, y) in enumerate(made):  # grows on the way
        xs, ys = left[x] if x is not None else [], right[y] if y is not None else []
        i = j = 0
        rows: list[tuple] = []
        for p, q in partners.get(x, ()) if x is not None and y is not None else ():
            while xs[i] != p:
                rows.append((xs[i], None))
                i += 1
            while ys[j] != q:
                rows.append((None, ys[j]))
                j += 1
            rows.append((p, q))
            i, j = i + 1, j + 1
        rows += [(p, None) for p in xs[i:]] + [(None, q) for q in ys[j:]]
        signs += [b[0][q] if p is None else a[0][p] for p, q in rows]
        parents += [at] * len(rows)
        made += rows
    return signs, parents


class Wrapper:
    """A host's slots, and what the votes say of them.

    `lists` lets elements and names hide blocks, `articles` prefers article and main elements; without both
    only the votes decide.
    """

    def __init__(self, tree: Tree, votes: list[dict] = (), lists: bool = True, articles: bool = True):
        self.tree, self.maps = tree, {}
        self.signs, self.parents = tree
        seen = {v["slot"]: v for v in votes}
        different = seen.get(-1, {"pages": 0})["pages"]
        own, mass, held = self._masses(seen, different)
        inside, hidden = [False], [False]
        for slot in range(1, len(self.signs)):
            up, tag = self.parents[slot], self.signs[slot].split(".")[0]
            bad = hidden[up] or _silent(self.signs[slot])
            if lists and not bad:
                named = _named(self.signs[slot], inside[up]) and not (mass[0] and mass[slot] >= MOST * mass[0])
                bad = tag in ASIDE or named
            hidden.append(bad)
            inside.append(inside[up] or articles and not bad and tag in ROOTS)
        self.hidden, self.inside = hidden, inside
        self.template, self.constant = set(), set()
        for slot, vote in seen.items():
            if slot < 0:
                continue
            if different >= LEAST_PAGES:
                self.constant.update((slot, text) for text in vote["constant"])
            if not inside[slot] and vote["holders"] >= LEAST_PAGES and vote["all_links"] > LINKS * max(1, vote["all_chars"]):
                self.template.add(slot)
        self.under = self._under(own, mass, held)

    def _masses(self, seen: dict, different: int) -> tuple[list[float], list[float], list[float]]:
        """Running text a page, of every slot and with all below, and that of pages that have any there.

        The host's own pages count, and as many as SHARED pages of all hosts.
        """
        own, share = [0.0] * len(self.signs), [0.0] * len(self.signs)
        for slot, v in seen.items():
            if slot >= 0 and different:
                shared = (v["all_chars"] - v["all_links"]) / v["all_pages"]
                own[slot] = (v["chars"] - v["links"] + SHARED * shared) / (different + SHARED)
                share[slot] = (v["pages"] + SHARED * v["holders"] / v["all_pages"]) / (different + SHARED)
        mass = own.copy()
        for slot in range(len(mass) - 1, 0, -1):
            mass[self.parents[slot]] += mass[slot]
            share[self.parents[slot]] = max(share[self.parents[slot]], share[slot])
        return own, mass, [m / s if s else 0.0 for m, s in zip(mass, share, strict=True)]

    def _under(self, own: list[float], mass: list[float], held: list[float]) -> list[bool]:
        """Which slots are in the article, as the votes have it."""
        below, top = _below(self.tree), 0
        while True:
            down = [s for s in below[top] if not self.hidden[s]]
            # a heading with the text it stands above
            if any(self.signs[s].split(".")[0] in HEADINGS and own[s] and s not in {c for c, _ in self.constant} for s in down):
                break
            best = max(down, key=lambda s: mass[s], default=None)
            if best is None or not mass[best] or mass[best] < MOST * mass[top] or own[best] > mass[best] / 2:
                break
            if any(held[s] >= BESIDE * held[best] for s in down if s != best):
                break
            top = best
        under = [False] * len(self.signs)
        under[top] = True
        for slot in range(top + 1, len(under)):
            under[slot] = slot == top or under[self.parents[slot]]
        return under

    def place(self, root: Node) -> None:
        """Give every node of a page its slot; -2 without one."""
        folded = fold(root)
        key = json.dumps(folded)
        slots = self.maps.get(key)
        if slots is None:
            slots = [-2] * len(folded[0])
            slots[0] = 0
            for pairs in matched(folded, self.tree)[1].values():
                for x, y in pairs:
                    slots[x] = y
            if len(self.maps) < 10_000:  # only spares work
                self.maps[key] = slots
        todo = [root]
        while todo:
            node = todo.pop()
            node.slot = slots[node.slot]
            todo += node.children


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _texts(root: Node, hidden) -> Iterator[tuple[Node, str]]:
    """(node, text) of every block in page order, white space folded; `hidden` nodes are skipped with all below."""
    stack, words, owner = [(root, 0)], [], None
    while stack:
        node, n = stack.pop()
        items = node.items
        while n < len(items):
            item = items[n]
            n += 1
            if isinstance(item, str):
                words.append(item)
                owner = node
            else:
                if words and (text := " ".join("".join(words).split())):
                    yield owner, text
                words = []
                if not hidden(item):
                    stack.append((node, n))
                    node, items, n = item, item.items, 0
        if words and (text := " ".join("".join(words).split())):
            yield owner, text
        words = []


def extract(root: Node, wrapper: Wrapper) -> str:
    """The blocks of content slots: of article elements where the page has one, else where the votes see the article, else of all."""
    kept, article, under = [], [], []
    for node, text in _texts(root, lambda n: n.slot >= 0 and wrapper.hidden[n.slot]):
        if node.slot in wrapper.template or wrapper.constant and (node.slot, _hash(text)) in wrapper.constant:
            continue
        kept.append(text)
        if node.slot >= 0 and wrapper.inside[node.slot]:
            article.append(text)
        if node.slot >= 0 and wrapper.under[node.slot]:
            under.append(text)
    return " ".join(article or under or kept)


def _paths(tree: Tree) -> list[int]:
    """A number per slot for the elements on the way to it."""
    paths: list[int] = []
    for sign, parent in zip(*tree, strict=True):
        paths.append(xxhash.xxh64_intdigest(sign, seed=paths[parent] if parent >= 0 else 0))
    return [p - (1 << 63) for p in paths]


def _host(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (a tree as JSON) for every host of `pages` (host, html)."""

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [json.dumps(fold(parse(x.as_py()))) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(trees, pa.string())], names=["host", "tree"])

    def induce(key, table):
        tree = None
        for text in sorted(table.column("tree").to_pylist()):
            other = tuple(json.loads(text))
            tree = other if tree is None else merge(tree, other)
        return pa.table({"host": [key[0].as_py()], "tree": [json.dumps(tree)]})

    trees = pages.select("host", "html").mapInArrow(outline, "host string, tree string").distinct()
    part = F.pmod(F.xxhash64("tree"), F.lit(64)).alias("part")
    some = trees.groupBy("host", part).applyInArrow(induce, "host string, tree string")
    return some.groupBy("host").applyInArrow(induce, "host string, tree string")


def votes(pages: DataFrame) -> DataFrame:
    """host and, per slot, how many different pages have text there, characters, of them in links, and hashes of texts most pages have there.

    Slot -1 is the whole page. Pages of a host with the same text vote once, and once for a text
    that they hold repeatedly. `all_chars`, `all_links`, `holders` (pages with text) and `all_pages` sum the slots that the
    same elements lead to on all hosts.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            out = {"host": [], "page": [], "slot": [], "path": [], "held": [], "chars": [], "links": []}
            for host, page, tree in zip(*(batch.column(c) for c in ("host", "html", "tree")), strict=True):
                host = host.as_py()
                if host not in known:
                    tree = tuple(json.loads(tree.as_py()))
                    known[host] = Wrapper(tree), _paths(tree)
                root, (wrapper, paths) = parse(page.as_py()), known[host]
                wrapper.place(root)
                held, shown, every = {}, [], []
                for node, text in _texts(root, lambda n: _silent(n.sign)):
                    held.setdefault(node.slot, []).append((text, node.links))
                    every.append(text)
                    if node.slot < 0 or not wrapper.hidden[node.slot]:
                        shown.append(text)
                whole = _hash(" ".join(shown or every))
                held = {-1: [], **{slot: texts for slot, texts in held.items() if slot >= 0}}
                for slot, texts in held.items():
                    out["host"].append(host)
                    out["page"].append(whole)
                    out["slot"].append(slot)
                    out["path"].append(paths[slot] if slot >= 0 else 0)
                    out["held"].append(sorted({_hash(t) for t, _ in texts}))
                    chars = sum(len(t) for t, _ in texts)
                    out["chars"].append(chars)
                    out["links"].append(min(chars, sum(n for _, n in texts)))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    folder = fresh_folder(pages.sparkSession, "ballots")
    rows = pages.mapInArrow(vote, "host string, page long, slot int, path long, held array<long>, chars long, links long")
    rows = rows.groupBy("host", "page", "slot", "path").agg(F.min(F.struct("held", "chars", "links")).alias("one"))
    rows = written(rows.select("host", "page", "slot", "path", "one.*"), folder)
    slots = rows.groupBy("host", "slot", "path").agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    slots = written(slots, f"{folder}-slots")
    different = hinted(slots.where("slot = -1").select("host", F.col("pages").alias("different")))
    alike = slots.where("slot >= 0").join(different, "host").groupBy("path").agg(
        F.sum("chars").alias("all_chars"), F.sum("links").alias("all_links"), F.sum("pages").alias("holders"), F.sum("different").alias("all_pages")
    )
    texts = rows.where("slot >= 0").select("host", "slot", F.explode("held").alias("held")).groupBy("host", "slot", "held").count()
    texts = texts.join(different, "host").where(F.col("count") >= CONSTANT * F.col("different"))
    constant = texts.groupBy("host", "slot").agg(F.collect_list("held").alias("constant"))
    slots = slots.join(hinted(constant), ["host", "slot"], "left").withColumn("constant", F.coalesce("constant", F.array().cast("array<bigint>")))
    slots = slots.join(hinted(alike), "path", "left")
    fields = ("slot", "pages", "constant", "chars", "links", "all_chars", "all_links", "holders", "all_pages")
    return slots.groupBy("host").agg(F.collect_list(F.struct(*fields)).alias("votes"))


def main_text(pages: DataFrame, lists: bool = True, articles: bool = True) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`.

    Without `lists` no element or name hides a block, without `articles` article and main elements are like others: then the
    votes alone find the text.

    Defined cases: null and empty html has an empty text; pages without a url or host form a host
    of their own; rows that share a page_id are extracted one by one; constant texts are
    looked for on hosts with 5 and more different texts, the article's slot on all. Broken markup is read as far as it goes, nested to
    any depth. Other columns are not read.
    """
    folder = fresh_folder(pages.sparkSession, "wrappers")
    rows = pages.select(F.col("page_id"), F.col("url"), _host("url").alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    trees = written(wrappers(rows), f"{folder}/trees")
    ready = written(trees.join(votes(rows.select("host", "html").join(hinted(trees), "host")), "host", "left"), f"{folder}/votes")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = []
            for host, page, tree, voted in zip(*(batch.column(c) for c in ("host", "html", "tree", "votes")), strict=True):
                host = host.as_py()
                if host not in known:
                    known[host] = Wrapper(tuple(json.loads(tree.as_py())), voted.as_py() or (), lists, articles)
                root = parse(page.as_py())
                known[host].place(root)
                texts.append(extract(root, known[host]))
            counts = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), counts]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.join(hinted(ready), "host").mapInArrow(pick, f"page_id {kind}, url string, text string, n_chars long")

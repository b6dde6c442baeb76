"""Main text of web pages by wrapper induction over the pages of a host.

Each page becomes a small tree: siblings with the same tag and classes are one
node.  The tree that most pages of a host share is its template, and every
other tree of the host is aligned with it by simple tree matching.  Over all
pages of the host, a text that a slot of the template holds on most pages is
template text, also among others in one slot; the rest is content, unless its
tag or classes say that it is a menu, a footer, an advert or the like.  An
<article> or <main> mark is evidence, not a verdict: what is inside needs no
other, and its repeated texts are template while they are the lesser part of
the host's marked text, else the marked text itself is what pages share.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.session import discard, settle

#: Elements that never hold main text.
_DROPPED_TAGS = frozenset(
    "script style noscript template nav footer aside form button select option textarea input label head title iframe object "
    "svg canvas audio video map dialog menu".split()
)
#: Words of a class, id or role that mark such elements.
_DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar aside nav navbar "
    "navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments reply replies "
    "respond disqus widget toolbar pagination pager search legal complementary contentinfo header topbar form".split()
)
#: Words that may stand beside those in one class, as in site-footer; a class with any other word (has-comments) says something else.
_AROUND_WORDS = frozenset(
    "site page main top bottom left right list box bar block area container wrapper wrap inner section slot unit item link links button "
    "buttons icons panel".split()
)
_TALK_WORDS = frozenset("comment comments reply replies respond disqus".split())
_ARTICLE_WORDS = frozenset("article post entry story".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_CLOSES_P = _BLOCKS - {"body", "html", "tbody", "td", "tfoot", "th", "thead", "tr"}
_CLOSED_BY_OWN = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "option": ("select",)}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:[\"'][^>]*)?)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+|\d+")
_ROOT = [-1, "html"]


def _label(tag: str, attributes: str) -> str:
    """Tag with its classes, id and role, each as its words without numbers."""
    if not attributes or attributes.isspace():
        return tag
    tokens = [t.lower() for m in _ATTRIBUTE.finditer(attributes) for t in (m[2] or m[3] or m[4] or "").split()]
    names = {"-".join(w for w in _WORD.findall(t) if not w.isdigit()) for t in tokens}
    return ".".join([tag, *sorted(names - {""})])


@lru_cache(maxsize=10_000)
def _named_dropped(label: str) -> frozenset[str]:
    """The words by which a whole class, id or role says that an element holds no main text; never for an article."""
    tag, *names = label.split(".")
    if tag in ("article", "main"):
        return frozenset()
    parts = [frozenset(name.split("-")) for name in names]
    marked = frozenset().union(*(p & _DROPPED_WORDS for p in parts if p <= _DROPPED_WORDS | _AROUND_WORDS))
    return marked - {"header"} if _ARTICLE_WORDS.intersection(names) else marked


def _is_dropped(label: str) -> bool:
    """Whether the tag or a name of an element says that it holds no main text (a header may, inside an article)."""
    return label.split(".")[0] in _DROPPED_TAGS or bool(_named_dropped(label))


def parse(page: str | None) -> tuple[list, list[tuple[int, str, int]]]:
    """The tree of a page and its blocks of text.

    The tree is a list of [parent, label]; siblings with one label are one
    node.  A block is (node, text, characters inside links), in page order,
    with references decoded and white space made one space.
    """
    nodes, index = [_ROOT], {}
    stack, blocks, buffer = [("html", 0)], [], []
    skipped = linked = in_link = at = 0
    page = page or ""

    def flush():
        nonlocal linked
        if text := " ".join("".join(buffer).split()):
            blocks.append((stack[-1][1], text, linked))
        buffer.clear()
        linked = 0

    def text_until(end: int):
        nonlocal linked
        if end > at and not skipped:
            buffer.append(html.unescape(page[at:end]))
            linked += in_link * len(buffer[-1])

    while found := _TOKEN.search(page, at):
        text_until(found.start())
        at = found.end()
        closing, tag, attributes = found.group(1, 2, 3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = 0 if closing else 1
        if tag == "br":
            buffer.append(" ")
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                if tag in _BLOCKS:
                    flush()
                skipped -= sum(node < 0 for _, node in stack[depth:])
                del stack[depth:]
            elif tag in _BLOCKS:
                flush()
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        label = _label(tag, attributes)
        if tag not in _BLOCKS:
            if _is_dropped(label) and not attributes.endswith("/"):
                stack.append((tag, -1))
                skipped += 1
            continue
        flush()
        if tag in _CLOSES_P and stack[-1][0] == "p":
            stack.pop()
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag and tag in _CLOSED_BY_OWN:
                skipped -= sum(node < 0 for _, node in stack[depth:])
                del stack[depth:]
                break
            if stack[depth][0] in _CLOSED_BY_OWN.get(tag, (stack[depth][0],)):
                break
        if tag in ("html", "body"):
            continue
        parent = next(node for _, node in reversed(stack) if node >= 0)
        key = (parent, label)
        if key not in index:
            index[key] = len(nodes)
            nodes.append([parent, label])
        stack.append((tag, index[key]))
    text_until(len(page))
    flush()
    return nodes, [b for b in blocks if b[0] >= 0]


def _children(nodes: list) -> list[list[int]]:
    out = [[] for _ in nodes]
    for i, (parent, _) in enumerate(nodes):
        if parent >= 0:
            out[parent].append(i)
    return out


def align(template: list, tree: list) -> dict[int, int]:
    """Node of ``tree`` to node of ``template`` by simple tree matching (largest order-keeping match of equal labels).

    Siblings differ in label, so a node has one partner at most and the best
    order-keeping match of two rows of children is their heaviest increasing
    run.  Neither depth nor width is bounded: no recursion, no table of pairs.
    """
    if template[0][1] != tree[0][1]:
        return {}
    ours, theirs = _children(template), _children(tree)
    partners, pairs = {}, [(0, 0)]
    for a, b in pairs:  # grows while it is read: parents come before children
        by_label = {tree[y][1]: (j, y) for j, y in enumerate(theirs[b])}
        partners[b] = [(x, *by_label[template[x][1]]) for x in ours[a] if template[x][1] in by_label]
        pairs += [(x, y) for x, _, y in partners[b]]
    score, chosen = {}, {}
    for _, b in reversed(pairs):
        places, weights = [j for _, j, _ in partners[b]], [score[y] for _, _, y in partners[b]]
        run = heaviest_increasing(places, weights)
        chosen[b] = [partners[b][i] for i in run]
        score[b] = 1 + sum(weights[i] for i in run)
    found, todo = {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        found[b] = a
        todo += [(x, y) for x, _, y in chosen[b]]
    return found


def heaviest_increasing(places: list[int], weights: list[int]) -> list[int]:
    """Positions of the heaviest run whose places increase, by a tree of the best end below each place."""
    if all(x < y for x, y in zip(places, places[1:])):
        return list(range(len(places)))
    size = max(places) + 2
    best: list[tuple[int, int]] = [(0, -1)] * size  # weight and position of its last one
    before = []
    for i, (place, weight) in enumerate(zip(places, weights)):
        at, low = place, (0, -1)  # places below this one
        while at:
            low = max(low, best[at])
            at -= at & -at
        before.append(low[1])
        at = place + 1
        while at < size:
            best[at] = max(best[at], (low[0] + weight, i))
            at += at & -at
    at, last = size - 1, (0, -1)
    while at:
        last = max(last, best[at])
        at -= at & -at
    run, i = [], last[1]
    while i >= 0:
        run.append(i)
        i = before[i]
    return run[::-1]


def heading_nodes(tree: list) -> list[bool]:
    return [re.fullmatch(r"h[1-6]", label.split(".")[0]) is not None for _, label in tree]


def article_nodes(tree: list) -> dict[int, bool]:
    """For each node whether it is in an <article> or <main> that the page marks, and not in an element dropped by tag."""
    inside = {}
    for i, (parent, label) in enumerate(tree):  # parents come first
        tag = label.split(".")[0]
        inside[i] = (inside.get(parent, False) or tag in ("article", "main")) and tag not in _DROPPED_TAGS
    return inside


def unmarked_nodes(tree: list) -> dict[int, bool]:
    """For each node whether neither it nor what holds it is dropped by tag; headers hold no main text here."""
    out = {}
    for i, (parent, label) in enumerate(tree):
        out[i] = out.get(parent, True) and label.split(".")[0] not in _DROPPED_TAGS | {"header"}
    return out


def named_nodes(tree: list) -> dict[int, list[int]]:
    """For each node the elements dropped by name that hold it, itself among them."""
    out = {}
    for i, (parent, label) in enumerate(tree):
        out[i] = out.get(parent, []) + [i] * bool(_named_dropped(label))
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string()), ("linked", pa.int32())]))
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            trees, blocks = [], []
            for page in part.column("html").to_pylist():
                tree, found = parse(page)
                trees.append(json.dumps(tree))
                blocks.append([{"node": n, "text": t, "linked": k} for n, t, k in found])
            columns = [*part.drop_columns(["html"]).columns, pa.array(trees), pa.array(blocks, block)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "host", "tree", "blocks"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, tree key, tree, template) to one row per node: its slot, what marks and tags say, and the slots dropped by name that hold it."""
    names = ["host", "key", "node", "slot", "marked", "open", "named", "talk", "heading"]
    for batch in batches:
        out = []
        for host, key, tree, template in zip(*(c.to_pylist() for c in batch.columns)):
            own = json.loads(tree)
            slots, inside, free, named = align(json.loads(template), own), article_nodes(own), unmarked_nodes(own), named_nodes(own)
            # A node without a slot has a name of its own, so it is compared over the pages of this tree only.
            slot = [f"{slots[node]}" if node in slots else f"{key}:{node}" for node in range(len(own))]
            heading = heading_nodes(own)
            for node in range(len(own)):
                talk = any(_named_dropped(own[n][1]) & _TALK_WORDS for n in named[node])
                out.append((host, key, node, slot[node], inside[node], free[node], [slot[n] for n in named[node]], talk, heading[node]))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


REPEATED = 0.5  # share of a slot's differing pages, besides the page itself, that hold a text from which it is template
LINKED = 0.7  # share of a slot's characters inside links from which it is a list of links


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``df``: ``id_col, url_col, text, n_chars``.

    Blocks of main text are joined by a line feed.  A null or empty page has an
    empty text; a null url counts as an empty host.  Pages that repeat are
    pages of their own.  A text that a slot repeats over a host is template only
    where the slot occurs in pages that differ, and in marked articles only
    while such texts are the lesser part of them; a heading there stays with
    the text after it.  An element with a class, id or
    role that names a menu, an advert or the like is left out, unless it holds most
    of what varies over a host without marked articles.
    Other columns are ignored.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    kind = pages.schema["id"].dataType.simpleString()
    schema = f"id {kind}, url string, host string, tree string, blocks array<struct<node int, text string, linked int>>"
    parsed = settle(pages.mapInArrow(_parsed, schema).withColumn("key", F.xxhash64("tree")), "parsed")

    # The template of a host is the tree that most of its pages have.
    trees = parsed.groupBy("host", "key").agg(F.first("tree").alias("tree"), F.count(F.lit(1)).alias("pages"))
    trees = settle(trees, "trees")
    templates = trees.groupBy("host").agg(F.max_by("tree", F.struct("pages", "key")).alias("template"))
    meetings = trees.join(templates, "host").select("host", "key", "tree", "template")
    kinds = "host string, key long, node int, slot string, marked boolean, open boolean, named array<string>, talk boolean, heading boolean"
    nodes = settle(meetings.mapInArrow(_aligned, kinds), "nodes")
    discard(trees)

    # What the texts of a slot do over all pages of the host; copies of a page say nothing about what its template is.
    block = F.transform("blocks", lambda b: F.struct(b["node"], F.xxhash64(b["text"]).alias("text"), b["linked"], F.length(b["text"]).alias("chars")))
    hashed = parsed.select("host", "key", F.xxhash64(F.col("blocks.text")).alias("page"), block.alias("b"))
    one = hashed.groupBy("host", "page").agg(F.min("key").alias("key"))
    seen = hashed.join(one, ["host", "page", "key"], "left_semi").select("host", "key", "page", F.explode("b").alias("b")).select("host", "key", "page", "b.*")
    seen = settle(seen, "seen")
    sizes = seen.groupBy("host", "key", "node").agg(
        F.count_distinct("page").alias("pages"), F.sum("linked").alias("linked"), F.sum("chars").alias("chars")
    )
    slots = nodes.join(sizes, ["host", "key", "node"]).groupBy("host", "slot").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), (F.sum("linked") / F.sum("chars")).alias("share"), F.max(F.col("marked") & (F.size("named") == 0)).alias("marked"),
    )
    slots = settle(slots, "slots")
    texts = seen.groupBy("host", "key", "node", "text").agg(F.count_distinct("page").alias("on"), F.sum("chars").alias("chars"))
    texts = texts.join(nodes, ["host", "key", "node"]).groupBy("host", "slot", "text").agg(F.sum("on").alias("on"), F.sum("chars").alias("same"))
    template = texts.where("on > 1").join(slots, ["host", "slot"]).where(f"on - 1 >= {REPEATED} * pages")
    template = settle(template.select("host", "slot", "text", "same"), "template")
    discard(seen)

    # Where most of the marked text repeats, the pages share their articles.
    same = template.groupBy("host", "slot").agg(F.sum("same").alias("same"))
    marks = slots.where("marked").join(same, ["host", "slot"], "left").groupBy("host").agg((F.sum("same") * 2 > F.sum("chars")).alias("shared"))

    # An element dropped by name is not if, of the text that varies over the host, it holds most and no marked article holds any.
    varying = F.col("chars") - F.coalesce("same", F.lit(0))
    loads = slots.where(f"share < {LINKED}").join(same, ["host", "slot"], "left").select("host", "slot", "marked", "pages", varying.alias("load"))
    allowed = nodes.where("(marked OR open) AND NOT talk").select("host", "slot", "named").distinct()
    loads = allowed.groupBy("host", "slot").agg(F.array_distinct(F.flatten(F.collect_set("named"))).alias("named")).join(loads, ["host", "slot"])
    whole = loads.groupBy("host").agg(F.max("pages").alias("pages"), F.sum("load").alias("whole"), F.coalesce(F.sum(F.when(F.col("marked"), F.col("load"))), F.lit(0)).alias("in_marks"))
    held = loads.select("host", "load", F.explode("named").alias("holder")).groupBy("host", "holder").agg(F.sum("load").alias("load"))
    cleared = held.join(whole.where("in_marks = 0 AND pages > 1"), "host").where("load * 2 > whole").groupBy("host").agg(F.collect_set("holder").alias("cleared"))
    named = F.size(F.array_except("named", F.coalesce("cleared", F.array().cast("array<string>")))) > 0
    nodes = nodes.join(cleared, "host", "left").where(~named).drop("named", "talk", "cleared")

    kept = nodes.join(slots.drop("marked"), ["host", "slot"]).where(F.col("marked") | F.col("open") & (F.col("share") < LINKED))
    fixed = kept.join(template, ["host", "slot"]).join(marks, "host", "left").where("NOT (marked AND coalesce(shared, false))")
    fixed = fixed.groupBy("host", "key").agg(F.collect_set(F.struct("node", "text")).alias("fixed"))  # at most a few for each block of a page
    heads = F.collect_set(F.when(F.col("marked") & F.col("heading"), F.col("node"))).alias("heads")
    kept = kept.groupBy("host", "key").agg(F.collect_set("node").alias("kept"), heads).join(fixed, ["host", "key"], "left")  # nodes of one tree
    kept = settle(kept, "kept")  # its true size shows whether the texts must move

    changes = lambda b: ~F.coalesce(F.array_contains("fixed", F.struct(b["node"], F.xxhash64(b["text"]).alias("text"))), F.lit(False))
    shows = lambda b: F.array_contains("kept", b["node"]) & changes(b)
    # In a marked article a repeated heading belongs to the text that comes next, if that is shown.
    following = lambda i: F.get("blocks", i + 1)
    heads_text = lambda b, i: F.array_contains("heads", b["node"]) & F.coalesce(shows(following(i)), F.lit(False))
    main = F.filter("blocks", lambda b, i: shows(b) | heads_text(b, i))
    found = parsed.join(kept, ["host", "key"], "left")
    joined = F.coalesce(F.concat_ws("\n", F.transform(main, lambda b: b["text"])), F.lit(""))
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), joined.alias("text"), F.length(joined).cast("long").alias("n_chars"))

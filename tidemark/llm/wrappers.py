"""Main text of web pages by wrappers: union-free expressions inferred from the pages of a host."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import rows_and, stage

#: Shapes or wrappers that are merged in one task; more of a host go through further rounds.
MERGED = 64
#: Levels of elements that a tree has; deeper ones are read as if they lay side by side.
DEEPEST = 100
#: Longest group of neighbours that is tried as a repetition.
GROUP = 3
#: Share of a part's characters from which an article or main element in it is its main part.
LEAST_SHARE = 1 / 3
#: Share of the different pages with a slot from which a link in it belongs to the template, and how many at least.
TEMPLATE_SHARE, LEAST_PAGES = 0.9, 2

# HTML's own element lists, fixed by its standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noframes", "svg"}
#: Of these, what holds code: up to the next end tag, whatever stands between.
CODE = {"script", "style"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
CLOSES_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table", "select", "article", "body", "html"}

# What is no main text: elements, and whole words in class, id or role, or such words with a qualifier of place or form.
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "head", "menu"}
ASIDE_WORDS = re.compile(
    r"(?:^|\s)(?:(?:site|page|main|global|primary|secondary|top|bottom|left|right|header|post|entry|article|js)[_-]+)*"
    r"(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|sidebar|aside|footer|masthead|"
    r"notices?|cookie\w*|consent|alert|popup|modal|newsletter|subscri\w+|comments?|disqus|repl(?:y|ies)|share|sharing|"
    r"social|related|recommend\w*|breadcrumbs?|pagination|search|login|complementary|contentinfo|navigation)"
    r"(?:[_-]+(?:box|bar|banner|notice|wrapper|wrap|container|block|section|area|slot|unit|list|item|items|links|buttons|form|"
    r"posts|articles|thread|top|bottom|left|right|header|footer|inner|outer|\d+))*(?:$|\s)",
    re.IGNORECASE,
)
#: Elements that hold the page or its main text, whatever their labels say.
HOLDERS = {"html", "body", "main", "article"}
MAIN = ("article", "main")

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""", re.DOTALL)
BROKEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!/A-Za-z][^>]*\Z")
LABEL = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>")


def own_ends(html: str, name: str) -> dict[int, int]:
    """Where the elements of this name that have an end tag of their own end, by where they start."""
    tag = rf"""<(/?){re.escape(name)}(?=[\s/>])(?:((?:[^>"']++|"[^"]*"|'[^']*')*+)>|[^>]*(?:>|\Z))"""
    ends, begun = {}, []
    for found in re.finditer(tag, html, re.IGNORECASE):
        if not found.group(1):
            if not (found.group(2) or "").endswith("/"):
                begun.append(found.start())
        elif begun:
            ends[begun.pop()] = found.end()
    return ends


def code_end(html: str, name: str, at: int, closed: bool) -> int:
    """Where code from ``at`` on ends: with its end tag, else before what looks like markup again."""
    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
    if closed and not (end and not re.compile(rf"<{name}[\s/>]", re.IGNORECASE).search(html, at, end.start())):
        return at
    if end:
        return end.end()
    tag = TAG.search(html, at)
    return tag.start() if tag else len(html)


def events(html: str) -> Iterator[tuple[str, str, str]]:
    """``("text", "", text)``, ``("open", name, labels)`` and ``("close", name, "")`` in page order."""
    at, size, ends, formula = 0, len(html), {}, False
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            yield "text", "", html[at:lt]
        if lt == size:
            return
        found = MARKUP.match(html, lt) or BROKEN.match(html, lt)
        if not found:
            yield "text", "", "<"
            at = lt + 1
            continue
        at = found.end()
        name = found.group(2)
        if not name:
            continue
        name = name.lower()
        if found.group(1):
            formula = formula and name != "math"
            yield "close", name, ""
            continue
        closed = found.group(3).endswith("/")
        labels = " ".join(x for m in LABEL.finditer(found.group(3)) for x in m.groups()[1:] if x)
        if name in RAW:  # its content is no markup and no text of the page
            if name in CODE:
                at = code_end(html, name, at, closed)
            else:
                if name not in ends:
                    ends[name] = own_ends(html, name)
                at = max(at, ends[name].get(lt, at))
            continue
        formula = formula or name == "math"
        yield "open", name, labels
        if formula and closed:  # as XML has it, which HTML follows in formulas only
            formula = name != "math"
            yield "close", name, ""


def blocks_of(html: str) -> tuple[list, list[tuple[str, str]]]:
    """The page's tree of elements and text slots, and its blocks as ``(path, text, link)`` in page order.

    A node is ``[name, children]``; a text slot is ``["#", [number of the block]]``. Inline elements leave no trace;
    elements that HTML closes by itself are closed here. Marked elements are named with a ``!``. A block is a link if
    all its text is. A tree has ``DEEPEST`` levels: what lies deeper stands side by side at the last one, and of its
    path only main elements and marks are kept, once each.
    """
    from collections import Counter
    from html import unescape

    # an open element: its name, the children it adds to, its path
    top: list = []
    stack: list[tuple[str, list, str]] = [("", top, "")]
    blocks, open_text, links = [], [], []
    named: Counter = Counter()
    linked = False

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(open_text)).split())
        if text:
            stack[-1][1].append(["#", [len(blocks)]])
            blocks.append((stack[-1][2], text, all(links)))
        open_text.clear()
        links.clear()
        linked = False

    def close(names: set[str], within: set[str]) -> None:
        if not any(named[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            plain = stack[depth][0].rstrip("!")
            if plain in names:
                for gone, _, _ in stack[depth:]:
                    named[gone.rstrip("!")] -= 1
                del stack[depth:]
                return
            if plain in within:
                return

    for kind, name, data in events(html):
        if kind == "text":
            open_text.append(data)
            if not data.isspace():
                links.append(linked)
        elif name in INLINE and not (kind == "open" and ASIDE_WORDS.search(data)):
            linked = kind == "open" if name == "a" else linked
        else:
            flush()
            if kind == "close":
                close({name}, set() if name in SCOPES else {"body", "html"} if name != "p" else SCOPES)
                continue
            if name in CLOSES_P:
                close({"p"}, SCOPES | {"div", "section", "td", "th", "li"})
            if name in CLOSES_LIKE:
                close(CLOSES_LIKE[name], SCOPES)
            in_main = named["article"] or named["main"]
            aside = name in ASIDE or (name not in HOLDERS and ASIDE_WORDS.search(data)) or (name == "header" and not in_main)
            written = name + "!" if aside else name
            _, children, path = stack[-1]
            if len(stack) <= DEEPEST:
                node = [written, []]
                children.append(node)
                children, path = node[1], f"{path}>{written}" if path else written
            elif (aside or name in MAIN) and written not in path.split(">"):
                path = f"{path}>{written}"
            if name not in VOID:
                stack.append((written, children, path))
                named[name] += 1
    flush()
    return top, blocks


# An expression is a list of items [optional, repeated, body]; a body is a list of [name, expression].
# Below a slot "#" are the texts it holds instead: blocks of a page, or slots of the expressions joined in it.


def label(item: list) -> str:
    return " ".join(name for name, _ in item[2])


def merged(a: list, b: list, optional: bool = False, repeated: bool = False) -> list:
    """One item for two whose bodies have the same names."""
    body = [[name, x + y if name == "#" else align(x, y)] for (name, x), (_, y) in zip(a[2], b[2], strict=True)]
    return [a[0] or b[0] or optional, a[1] or b[1] or repeated, body]


def fold(items: list) -> list:
    """Neighbours that repeat become one repeated item, shortest group first."""
    for size in range(1, GROUP + 1):
        out, at = [], 0
        while at < len(items):
            group = items[at : at + size]
            names = [label(i) for i in group]
            end = at + size
            plain = size == 1 or not any(i[0] or i[1] for i in group)
            one = group[0] if size == 1 else [False, False, [node for i in group for node in i[2]]]
            while plain and len(group) == size and [label(i) for i in items[end : end + size]] == names:
                more = items[end : end + size]
                if size > 1 and any(i[0] or i[1] for i in more):
                    break
                other = more[0] if size == 1 else [False, False, [node for i in more for node in i[2]]]
                one = merged(one, other, repeated=True)
                end += size
            if end > at + size:
                out.append(one)
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def expression(children: list) -> list:
    """The expression of a page's tree."""
    return fold([[False, False, [[name, below if name == "#" else expression(below)]]] for name, below in children])


def align(a: list, b: list) -> list:
    """The smallest expression found that holds both: equal labels are joined in order (a longest
    common subsequence), a repeated group takes up a single one, all else becomes optional."""
    if a == b:
        return a
    left, right = [label(i) for i in a], [label(i) for i in b]
    if left == right:
        return [merged(x, y) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i] == right[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and left[i] == right[j]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([True, *a[i][1:]])
            i += 1
        else:
            out.append([True, *b[j][1:]])
            j += 1
    return fold(out)


def infer(expressions: Iterable[str]) -> str:
    """The wrapper of a host from the expressions of its pages, or from partial wrappers."""
    wrapper = None
    for text in expressions:
        page = json.loads(text)
        wrapper = page if wrapper is None else align(wrapper, page)
    return json.dumps(wrapper or [], separators=(",", ":"))


def slots(expression: list) -> Iterator[list]:
    """The slots of an expression in its order, each ``["#", what it holds]``."""
    for _, _, body in expression:
        for node in body:
            if node[0] == "#":
                yield node
            else:
                yield from slots(node[1])


def emptied(expression: list) -> list[list]:
    """What the slots of an expression held, which is taken out of them."""
    held = []
    for node in slots(expression):
        held.append(node[1])
        node[1] = []
    return held


def places(wrapper: str, shape: str) -> list[int]:
    """The wrapper's slot for each slot of a page's expression: joining both puts them together."""
    whole, page = json.loads(wrapper), json.loads(shape)
    for number, node in enumerate(slots(whole)):
        node[1] = [number]
    count = 0
    for count, node in enumerate(slots(page), 1):
        node[1] = [-count]
    found = list(range(-count, 0))[::-1]  # a slot that met none is a place of its own
    for _, held in slots(align(whole, page)):
        met = [n for n in held if n >= 0]
        for n in held:
            if n < 0 and met:
                found[-n - 1] = min(met)
    return found


def main_blocks(known: DataFrame) -> DataFrame:
    """``known`` with ``blocks`` cut down to each page's main text.

    Each page decides for itself: its links of the host's template go, unless nothing would be left.
    Then a page's articles are taken, else its main element, else all; a marked part with less than
    ``LEAST_SHARE`` of the next larger part's characters is no main part: teasers of a listing,
    comments marked up as articles.
    """

    def chars(of=lambda b: F.lit(True)) -> Column:
        return F.aggregate("blocks", F.lit(0), lambda n, b: n + F.when(of(b), b["size"]).otherwise(0))

    # one column a step: Spark would evaluate a nested expression once per mention
    steps = [
        ("left", F.when(F.col("template").isNotNull(), F.filter("blocks", lambda b: ~F.array_contains("template", b["at"])))),
        ("blocks", F.when(F.size("left") > 0, F.col("left")).otherwise(F.col("blocks"))),
        ("main", chars(lambda b: b["main"])),
        ("main", (F.col("main") > 0) & (F.col("main") >= LEAST_SHARE * chars())),
        ("blocks", F.when(F.col("main"), F.filter("blocks", lambda b: b["main"])).otherwise(F.col("blocks"))),
        ("main", chars(lambda b: b["article"])),
        ("main", (F.col("main") > 0) & (F.col("main") >= LEAST_SHARE * chars())),
        ("blocks", F.when(F.col("main"), F.filter("blocks", lambda b: b["article"])).otherwise(F.col("blocks"))),
    ]
    for name, value in steps:
        known = known.withColumn(name, value)
    return known


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


BLOCK = "struct<hash bigint, slot int, size int, main boolean, article boolean, link boolean, at int>"


def cluster_of(tree: list) -> int:
    """Pages of one template have the same outline: names of the two outer levels below the body, repeats once."""
    level = tree
    while len(below := [node for node in level if node[0] != "#"]) == 1 and below[0][0].rstrip("!") in ("html", "body"):
        level = below[0][1]
    outline = []
    for name, children in level:
        inner = sorted({child[0] for child in children}) if name != "#" else []
        if not outline or outline[-1] != (name, inner):
            outline.append((name, inner))
    return text_hash(json.dumps(outline))


def parsed(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``row, kept, host, texts, blocks, shape, cluster``: other columns as one struct, the page's
    expression and outline, and the texts and marks of its blocks that are not aside."""

    def each(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"hash": pa.int64(), "slot": pa.int32(), "size": pa.int32(), "main": pa.bool_(), "article": pa.bool_(), "link": pa.bool_(), "at": pa.int32()}
        for batch in batches:
            texts, blocks, shapes, clusters = [], [], [], []
            for source in batch.column("html").to_pylist():
                tree, found = blocks_of(source or "")
                clusters.append(cluster_of(tree))
                shape = expression(tree)
                slot = {block: number for number, held in enumerate(emptied(shape)) for block in held}
                shapes.append(json.dumps(shape, separators=(",", ":")))
                named = [(slot[i], set(path.split(">")), text, link) for i, (path, text, link) in enumerate(found) if "!>" not in path + ">"]
                texts.append([text for _, _, text, _ in named])
                blocks.append([
                    (text_hash(text), place, len(text), "main" in names, "article" in names, link, at)
                    for at, (place, names, text, link) in enumerate(named)
                ])
            made = {
                "row": batch.column("row"), "kept": batch.column("kept"), "host": batch.column("host"),
                "texts": pa.array(texts, pa.list_(pa.string())), "blocks": pa.array(blocks, pa.list_(pa.struct(list(kinds.items())))),
                "shape": pa.array(shapes, pa.string()), "cluster": pa.array(clusters, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    others = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text")]
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.struct(*others).alias("kept"), host.alias("host"), F.col(html).alias("html"))
    schema = rows_and(rows.drop("html"), f"texts array<string>, blocks array<{BLOCK}>, shape string, cluster long")
    return rows.mapInArrow(each, schema)


def host_wrappers(shapes: DataFrame) -> DataFrame:
    """``host, cluster, wrapper`` of ``host, cluster, shape, n``.

    The shapes of a cluster are merged in parts of about ``MERGED``, the wrappers of the parts again
    in as many, and so on: a tree of rounds, in which no task holds more than one part.
    """

    def merge(frame):
        ordered = frame.sort_values(["n", "shape"], ascending=[False, True])
        first = ordered.iloc[:1][["host", "cluster"]]
        return first.assign(shape=infer(ordered["shape"]), n=int(frame["n"].sum()))

    while True:
        sizes = shapes.groupBy("host", "cluster").agg(F.count(F.lit(1)).alias("shapes"))
        parts = F.ceil(F.col("shapes") / MERGED).cast("long")
        salted = shapes.join(sizes.select(F.col("host").alias("h"), F.col("cluster").alias("c"), "shapes"), F.expr("host = h AND cluster = c"))
        salted = salted.withColumn("part", F.pmod(F.xxhash64("shape"), parts)).select("host", "cluster", "shape", "n", "part")
        shapes = stage(salted.groupBy("host", "cluster", "part").applyInPandas(merge, "host string, cluster long, shape string, n long"), "wrappers")
        if shapes.groupBy("host", "cluster").count().where("count > 1").isEmpty():
            return shapes.select("host", "cluster", F.col("shape").alias("wrapper"))


def shape_places(shapes: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``host, cluster, shape, places``: the wrapper's slots that the slots of each shape fall in."""

    def each(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [places(w, s) for w, s in zip(batch.column("wrapper").to_pylist(), batch.column("shape").to_pylist(), strict=True)]
            made = [batch.column(c) for c in ("host", "cluster", "shape")]
            yield pa.RecordBatch.from_arrays([*made, pa.array(found, pa.list_(pa.int32()))], ["host", "cluster", "shape", "places"])

    rows = shapes.join(wrappers, ["host", "cluster"]).select("host", "cluster", "shape", "wrapper")
    return rows.mapInArrow(each, "host string, cluster long, shape string, places array<int>")


def template_links(read: DataFrame, placed: DataFrame) -> DataFrame:
    """``row, template``: the blocks of a page that are links of its host's template.

    A link outside of article and main elements is template if ``TEMPLATE_SHARE`` of the different
    pages that have its slot, two at least, show the same there; pages with the same texts count
    once. Other text is never taken for template by counting. All is counted per text, so a host is
    no one task's work.
    """
    free = F.filter("blocks", lambda b: b["link"] & ~b["main"] & ~b["article"])
    page = F.xxhash64("blocks.hash")
    links = read.select("row", "host", "cluster", "shape", page.alias("page"), F.explode(free).alias("b"))
    place = F.element_at("places", F.col("b.slot") + 1)
    links = links.join(placed, ["host", "cluster", "shape"]).select(
        "row", "host", "cluster", "page", place.alias("place"), F.col("b.hash").alias("hash"), F.col("b.at").alias("at")
    )
    once = links.select("host", "cluster", "place", "hash", "page").distinct()
    pages = once.select("host", "cluster", "place", "page").distinct().groupBy("host", "cluster", "place").agg(F.count(F.lit(1)).alias("of"))
    shown = once.groupBy("host", "cluster", "place", "hash").agg(F.count(F.lit(1)).alias("n"))
    common = shown.join(pages, ["host", "cluster", "place"]).where((F.col("n") >= LEAST_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("of")))
    hits = links.join(common, ["host", "cluster", "place", "hash"])
    return hits.groupBy("row").agg(F.collect_list("at").alias("template"))  # no more than the page's own blocks


def main_text(pages: DataFrame, url: str, html: str) -> DataFrame:
    """All columns of ``pages`` but the html, with ``text``: the main text by the host's wrappers.

    Pages are parsed into blocks. Pages of a host with the same outline form a cluster, and the
    cluster's wrapper, which accepts each of them by construction, gives a block its slot. Links that
    a cluster's pages share in a slot are template; of the rest, in single, optional or repeated
    slots, each page takes its article, its main element or all for itself. Nothing in an article
    or main element, and no text other than links, goes by comparison with other pages. A page with
    no other text than the template's keeps it.

    NULL or empty html gives an empty text; a NULL or odd url counts as the host without a name;
    repeated rows stay; broken, unclosed or cut-off markup is read as far as it goes, however deep; an
    empty table gives no rows; a column named ``text`` is replaced, all others may have any name.
    """
    read = stage(parsed(pages, url, html), "pages")
    shapes = stage(read.groupBy("host", "cluster", "shape").agg(F.count(F.lit(1)).alias("n")), "shapes")
    placed = stage(shape_places(shapes, host_wrappers(shapes)), "places")
    template = stage(template_links(read, placed), "template")
    known = read.select("row", "kept", "texts", "blocks").join(template, "row", "left")
    text = F.array_join(F.transform("blocks", lambda b: F.element_at("texts", b["at"] + 1)), " ")
    return main_blocks(known).select("kept.*", F.coalesce(text, F.lit("")).alias("text"))

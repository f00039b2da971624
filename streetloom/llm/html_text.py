"""Main text of web pages by wrapper induction.

Pages of one host are laid out by one template.  Each page's DOM is reduced to a skeleton:
siblings of one signature (tag and class without digits) are one iterated node, with a digest
of its text.  One page of each host is the reference; every other skeleton is aligned with
it by simple tree matching, and each aligned node votes with its digest.  A node whose digest
is the same on most pages is template; all others are slots.  The wrapper of a host holds the
template nodes with their digests; a page loses such a node only where its text is that one.
Pages of a host with equal text vote once, so copies of a page do not make it template.

The text of a page is all that is not template.  Where ``main`` elements, else ``article``,
hold half of the varying text of a host, they alone are its slot; where they hold less
(teasers), the whole body is.  On hosts with too few pages to tell it is taken from the
page's ``main`` elements, else ``article``, else the body.
Elements that are never content by their tag (menus, scripts, footers) are left out everywhere.
Forms, headers that belong to no ``article``, ``main`` or ``section``, and elements that a role, class or id
calls no content (adverts, comments) are left out too, but not if they hold all ``article`` and
``main`` elements of the page.  Names count whole (``comments``) or in a compound whose other
words only name a place, a holder or an owner (``user-comments``, ``main-nav``, but neither
``has-sidebar`` nor ``share-prices``).  Some names may also be those of a layout (forms, menus,
sidebars): such an element stays where it holds nearly all varying text of its host or, on
small hosts, nearly all text of the page.

Each page is read twice; between the passes only skeletons, votes and wrappers exist, which
are small beside the pages, and votes are added up before they are shuffled.  A host with a
third of all pages is therefore no single group anywhere.

Defined results: a null or empty html has an empty text; a null url or one without a host
belongs to the host of the empty name; repeated rows are returned each; broken markup is
read as far as it goes; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.functions.markup import TolerantParser
from streetloom.llm.common import staged

#: A node is template or slot only if so many pages of the host aligned with it.
LEAST_PAGES = 5
#: Share of a host's varying text that marked elements hold where they are the slot.
MARKED = 0.5
#: An element that seems to be no content is layout if it holds so many times the other text.
LAYOUT = 4
#: Nodes below this depth belong to their ancestor there.
DEEPEST = 200

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Never content, wherever they stand.
DROPPED = set(
    "script style noscript template nav footer aside button select textarea input iframe "
    "object svg canvas audio video dialog menu head title".split()
)
#: A start tag of the key closes an open element of the values.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: An implied end does not pass these.
WALLS = set("table ul ol dl div section article main body td th blockquote".split())
DROPPED_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
#: Words of class and id that mark elements as not content, whatever their size.
FIRM_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr "
    "newsletter subscribe comment comments disqus respond reply replies".split()
)
#: Further ones, which a layout may carry too.
DROPPED_NAMES = FIRM_NAMES | set(
    "banner promo notice notices alert popup modal overlay signup sidebar menu navbar navigation nav "
    "breadcrumb breadcrumbs pagination pager share sharing social related recommended widget "
    "masthead footer toolbar skip".split()
)
#: Words that may stand beside one of these in a compound: places, holders, owners.
BESIDE = set(
    "area article articles bar block blog bottom box btn button buttons card cards col column "
    "container desktop entry fixed form global group holder icons inner item items left link links list "
    "lists main mobile module outer page panel post posts primary rail reader readers region right "
    "row secondary section site slot sticky stories story sub thread top unit user users web "
    "wrap wrapper zone".split()
)
#: Words beside those of reader comments.
OF_COMMENTS = {"comment", "comments", "reply", "replies"}
BESIDE_COMMENTS = BESIDE | {"author", "body", "content", "count", "meta", "text"}
#: Words beside ``header`` that call an element the header of the whole site.
OF_SITE = {"blog", "global", "site", "top", "web"}
#: A header inside these belongs to the content.
SECTIONS = {"article", "main", "section"}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Node:
    """An element; ``parts`` holds texts and child elements in page order."""

    __slots__ = ("tag", "name", "dropped", "doubtful", "firm", "parts")

    def __init__(self, tag: str, name: str = "", dropped: bool = False, doubt: int = 0):
        self.tag, self.name, self.parts = tag, name, []
        self.dropped = dropped or doubt > 0
        self.doubtful, self.firm = doubt > 0 and not dropped, dropped or doubt > 1


def _is_dropped(tag: str, attrs: dict) -> bool:
    if tag in DROPPED or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    return tag in ("article", "main") and any(OF_COMMENTS & set(n) for n in _names(attrs))


def _names(attrs: dict) -> list[list[str]]:
    """The words of each name in class and id."""
    if not ("class" in attrs or "id" in attrs):
        return []
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    return [[w.lower() for w in _WORD.findall(n)] for n in names]


def _doubt_of(words: list[str]) -> int:
    """Does a name call its element no content (1), whatever its size (2)?"""
    doubt = 0
    whole = "".join(words)
    for word in {whole, *words} & DROPPED_NAMES:
        beside = BESIDE_COMMENTS if word in OF_COMMENTS else BESIDE
        if word == whole or all(w in beside or w in DROPPED_NAMES for w in words):
            doubt = max(doubt, 2 if word in FIRM_NAMES else 1)
    return doubt


def _doubt(tag: str, attrs: dict, inside: bool) -> int:
    """0: may be content; 1: is none unless it is the layout; 2: is none.

    ``inside`` tells that the element stands in an article, main or section element.
    """
    if tag in ("html", "body", "article", "main"):
        return 0
    names = _names(attrs)
    doubt = max(map(_doubt_of, names), default=0)
    for words in names:
        others = set(words) - {"header"}
        if "header" in words and others <= OF_SITE and (others or not inside):
            doubt = 2
    if tag == "header" and not inside:
        doubt = 2
    if tag == "form" or (attrs.get("role") or "").lower() in DROPPED_ROLES:
        doubt = max(doubt, 1)
    return doubt


class _Reader(TolerantParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def _close(self, k: int) -> None:
        del self.open[max(k, 1):]

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag not in INLINE and tag not in VOID:
            closing = CLOSES.get(tag, set()) | {"p"}
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in closing:
                    self._close(k)
                    break
                if self.open[k].tag in WALLS:
                    break
        values = dict(attrs)
        name = re.sub(r"\d+", "", values.get("class") or "")
        doubt = _doubt(tag, values, any(n.tag in SECTIONS for n in self.open))
        node = Node(tag, " ".join(sorted(name.split())), _is_dropped(tag, values), doubt)
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self._close(k)
                return
            if tag in INLINE and self.open[k].tag not in INLINE:
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def parse(html: str | None) -> Node:
    """The element tree of a page."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    if not (regions(reader.root, "article") or regions(reader.root, "main")):
        keep_around(reader.root)
    return reader.root


def keep_around(root: Node) -> None:
    """Keep the doubtful elements that hold an article or main element."""
    stack = [(root, ())]
    while stack:
        node, above = stack.pop()
        if node.dropped and not node.doubtful:
            continue
        if node.tag in ("article", "main"):
            for outer in above:
                outer.dropped = False
            continue
        above = (*above, node) if node.dropped else above
        stack += [(p, above) for p in node.parts if isinstance(p, Node)]


def keep_layout(root: Node) -> None:
    """Keep the doubtful element that holds nearly all text of a page, and those around it."""
    found, stack = [], [(root, ())]
    while stack:
        node, above = stack.pop()
        if node.dropped and (node.firm or not node.doubtful):
            continue
        if node.dropped:
            above = (*above, node)
            found.append((sum(map(len, blocks([node]))), above))
        stack += [(p, above) for p in reversed(node.parts) if isinstance(p, Node)]
    size, largest = max(found, key=lambda f: f[0], default=(0, ()))
    if size >= LAYOUT * max(sum(map(len, blocks([root]))), 1):
        for node in largest:
            node.dropped = False


def walk(top: Node, skip=frozenset()):
    """Texts and block edges (None) in page order, without dropped elements and ``skip``.

    ``top`` itself is read even if it is dropped.
    """
    stack = [iter(top.parts if top.dropped else (top,))]
    ends: list = []
    while stack:
        part = next(stack[-1], stack)
        if part is stack:
            stack.pop()
            if ends:
                yield from ends.pop()
        elif isinstance(part, str):
            yield part
        elif part.dropped or id(part) in skip:
            if part.tag not in INLINE:
                yield None
        elif part.tag == "br":
            yield " "
        else:
            edge = () if part.tag in INLINE else (None,)
            yield from edge
            stack.append(iter(part.parts))
            ends.append(edge)


def blocks(tops: list[Node], skip=frozenset()) -> list[str]:
    """The texts of the blocks below ``tops``, white space turned into single spaces."""
    out, run = [], []
    for top in tops:
        for part in [*walk(top, skip), None]:
            if part is not None:
                run.append(part)
                continue
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                out.append(text)
    return out


def regions(root: Node, tag: str) -> list[Node]:
    """Outermost elements of a kind that are not inside dropped ones."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        if node.tag == tag:
            found.append(node)
            continue
        stack += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return found


class Bone:
    """A skeleton node: all siblings of one signature."""

    __slots__ = ("sign", "sons", "nodes", "digest", "size", "number")

    def __init__(self, sign: str, nodes: list[Node]):
        self.sign, self.nodes, self.sons = sign, nodes, []
        self.digest, self.size, self.number = "", 0, -1


def skeleton(root: Node) -> Bone:
    """The skeleton of a page, numbered in page order."""
    top = Bone("html", [root])
    todo, order = [(top, 0)], []
    while todo:
        bone, depth = todo.pop()
        bone.number = len(order)
        order.append(bone)
        text = "\n".join(blocks(bone.nodes))
        bone.size = len(text)
        bone.digest = blake2b(text.encode(errors="replace"), digest_size=8).hexdigest()
        if depth >= DEEPEST:
            continue
        kinds: dict[str, list[Node]] = {}
        for node in bone.nodes:
            for part in node.parts:
                if not isinstance(part, Node) or part.tag in INLINE:
                    continue
                if not part.dropped or (part.doubtful and not part.firm):
                    mark = "!." if part.dropped else ""
                    kinds.setdefault(f"{mark}{part.tag}.{part.name}", []).append(part)
        bone.sons = [Bone(sign, nodes) for sign, nodes in kinds.items()]
        todo += [(b, depth + 1) for b in reversed(bone.sons)]
    return top


def as_list(bone: Bone) -> list:
    return [bone.sign, bone.digest, bone.size, [as_list(b) for b in bone.sons]]


def from_list(value: list) -> Bone:
    """The skeleton that `as_list` wrote, numbered in page order again."""
    count = 0

    def build(item):
        nonlocal count
        bone = Bone(item[0], [])
        bone.digest, bone.size, bone.number = item[1], item[2], count
        count += 1
        bone.sons = [build(s) for s in item[3]]
        return bone

    return build(value)


def tree_match(a: Bone, b: Bone) -> tuple[int, list[tuple[Bone, Bone]]]:
    """Simple tree matching: the size of the largest matching and its pairs of nodes."""
    if a.sign != b.sign:
        return 0, []
    n, m = len(a.sons), len(b.sons)
    inner = [[tree_match(x, y) for y in b.sons] for x in a.sons]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            best[i][j] = max(
                best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + inner[i - 1][j - 1][0]
            )
    pairs, i, j = [(a, b)], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += inner[i][j][1]
    return best[n][m] + 1, pairs


def around(top: Bone, chosen: set[int]) -> set[int]:
    """The numbers ``chosen`` and those of all nodes that hold one of them."""
    found: set[int] = set()

    def visit(bone):
        held = [visit(son) for son in bone.sons]
        if any(held) or bone.number in chosen:
            found.add(bone.number)
        return bone.number in found

    visit(top)
    return found


def template_nodes(pairs: dict[int, Bone], wrapper: dict) -> set[int]:
    """Ids of the elements of a page whose text is the one that its host repeats."""
    known = {t["node"]: t["common"] for t in wrapper["template"]}
    same = [b for k, b in pairs.items() if b.size and known.get(k) == b.digest]
    return {id(n) for b in same for n in b.nodes}


def marked_text(root: Node) -> str:
    """The text of a page's main elements or, where they hold none, of its articles."""
    kinds = ("\n".join(blocks(regions(root, tag))) for tag in ("main", "article"))
    return next(filter(None, kinds), "")


def content(root: Node, wrapper: dict | None) -> str:
    """The main text of a page."""
    if wrapper is None:
        text = marked_text(root)
        if not text:
            keep_layout(root)
            text = "\n".join(blocks([root]))
        return text
    pairs = {b.number: a for a, b in tree_match(skeleton(root), from_list(wrapper["tree"]))[1]}
    layout = around(from_list(wrapper["tree"]), set(wrapper["layout"]))
    for k in layout & pairs.keys():
        for node in pairs.pop(k).nodes:
            if node.doubtful:
                node.dropped = False
    inside = wrapper["inside"]
    tops = inside and regions(root, inside) or [root]
    return "\n".join(blocks(tops, template_nodes(pairs, wrapper)))


def host_of(url):
    return F.coalesce(
        F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")
    )


def _skeletons(batches):
    for batch in batches:
        found = [as_list(skeleton(parse(h.as_py()))) for h in batch.column(1)]
        columns = [[f[1] for f in found], [json.dumps(f) for f in found]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.string()) for c in columns)],
            names=["host", "whole", "tree"],
        )


def _votes(batches):
    for batch in batches:
        out: list = [[], [], [], [], []]
        for host, tree, reference in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            _, pairs = tree_match(from_list(json.loads(tree)), from_list(json.loads(reference)))
            for own, other in pairs:
                vote = (host, other.number, own.digest, own.size, other.sign.split(".")[0])
                for column, value in zip(out, vote, strict=True):
                    column.append(value)
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            list(map(pa.array, out, kinds)), names=["host", "node", "digest", "size", "tag"]
        )


def wrappers(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per host: host and its wrapper as JSON (tree, template nodes, slot)."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"))
    trees = rows.mapInArrow(_skeletons, "host string, whole string, tree string")
    trees = trees.groupBy("host", "whole").agg(F.min("tree").alias("tree"))
    trees = staged(spark, trees, "skeletons")
    # the page with the smallest digest of its skeleton stands for its host
    reference = trees.groupBy("host").agg(
        F.min(F.struct(F.xxhash64("tree"), "tree")).alias("r")
    ).select("host", F.col("r.tree").alias("reference"))
    reference = staged(spark, reference, "references")
    votes = trees.join(reference, "host").select("host", "tree", "reference").mapInArrow(
        _votes, "host string, node int, digest string, size long, tag string"
    )
    counts = votes.groupBy("host", "node", "digest", "tag").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("chars")
    )
    nodes = counts.groupBy("host", "node", "tag").agg(
        F.sum("n").alias("pages"), F.max("n").alias("same"), F.count(F.lit(1)).alias("texts"),
        F.sum("chars").alias("varying"), F.max_by("digest", F.struct("n", "digest")).alias("common"),
    ).where(F.col("pages") >= LEAST_PAGES)
    constant = (2 * F.col("same") > F.col("pages")) & (F.col("pages") > F.col("texts"))
    # what marks the content is not template itself, and the whole of a page never is
    constant = constant & ~F.col("tag").isin("article", "main", "html")
    nodes = nodes.withColumn("constant", constant)
    chosen = nodes.groupBy("host").agg(
        F.collect_list(F.when(F.col("constant"), F.struct("node", "common"))).alias("template"),
        F.collect_list(
            F.when((F.col("tag") == "!") & ~F.col("constant"), F.struct("node", "varying"))
        ).alias("doubtful"),
        *[F.coalesce(F.sum(F.when(F.col("tag") == t, F.col("varying"))), F.lit(0)).alias(f"{t}_text")
          for t in ("html", "main", "article")],
    )
    inside = [F.when(F.col(f"{t}_text") >= F.greatest(MARKED * F.col("html_text"), F.lit(1)), F.lit(t))
              for t in ("main", "article")]
    # (an element in doubt is not part of the text of those around it)
    layout = F.filter(
        "doubtful", lambda x: x["varying"] >= LAYOUT * F.greatest("html_text", F.lit(1))
    )
    chosen = chosen.withColumn("layout", F.transform(layout, lambda x: x["node"]))
    chosen = chosen.withColumn("inside", F.coalesce(*inside, F.lit("")))
    return chosen.join(reference, "host").select(
        "host",
        F.concat(
            F.lit('{"template": '), F.to_json("template"), F.lit(', "layout": '),
            F.to_json("layout"), F.lit(', "inside": "'),
            "inside", F.lit('", "tree": '), "reference", F.lit("}"),
        ).alias("wrapper"),
    )


def extracted(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text and its number of code points."""
    known = staged(spark, wrappers(spark, pages), "wrappers")
    rows = pages.select(
        "page_id", "url", F.col("html").cast("string"), host_of(F.col("url")).alias("__host")
    ).join(known.withColumnRenamed("host", "__host"), "__host", "left")

    def run(batches):
        for batch in batches:
            texts = []
            for html, wrapper in zip(batch.column(2), batch.column(3), strict=True):
                wrapper = wrapper.as_py()
                texts.append(
                    content(parse(html.as_py()), None if wrapper is None else json.loads(wrapper))
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return rows.select("page_id", "url", "html", "wrapper").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )

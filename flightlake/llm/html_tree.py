"""Main text of web pages by a site style tree.

Pages of a host share templates. Their element paths are merged into one tree per host, kept as one row per host
and path. Two entropies say how much a path matters: of the shapes that its pages show, child sequences and length
of text (presentation), and of the texts that stand there (content). A text that every page repeats tells nothing;
texts of their own do. The elements around all text of a host are its frame; what hangs from the frame is a branch,
and a branch whose every part has one shape on all pages is a slot of the template, whatever words fill it. The
importance of a text is its content times the presentation of its branch.
Copies of one page are one witness: pages of a host that hold the same text blocks count once in the entropies.
Paths of low importance are left out of each page, besides the parts that markup itself names as menus, adverts,
forms and the like.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.storage import landed
from flightlake.llm.text import table

#: Texts of less importance go, where at least so many pages of the host, copies aside, show them: in a branch that has
#: fewer than about three shapes in common use.
THRESHOLD, EVIDENCE = 0.7, 10
#: Texts of less content than this are repeated by the host's pages and go from articles, too.
REPEATED = 0.3
#: The length of a text is taken in steps of so many words.
LENGTH_STEP = 16
FLUSH = 200_000
#: Longer paths keep their first elements, so that deep nesting costs memory in proportion to its depth.
PATH_CHARS, PATH_HEAD = 1024, 512

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe object math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr button select input img br".split()
)
ASIDE = frozenset("nav footer aside form button select option menu dialog head datalist".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p thead tbody tfoot".split())
MAIN = frozenset(["article", "main"])
HEADING = re.compile(r"/h[1-6](?:\.[^/]*)?\Z")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTR = re.compile(r"(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.IGNORECASE)
_HOST = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_NOISE = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|gdpr|sidebar|"
    r"nav|navbar|navigation|menu|breadcrumbs?|comments?|replies|respond|disqus|share|sharing|social|related|"
    r"newsletter|subscribe|signup|popup|modal|widget|footer|masthead|contentinfo|complementary|search"
)
#: Parts of a name that tell where or in what form something stands. Any other part makes the name that of a state
#: (no-sidebar, comments-off, share-enabled) or a subject (social-policy), which says nothing of what the part is.
_PLACE = frozenset(
    "main site page top bottom left right primary secondary global inner outer upper lower container wrapper wrap box bar "
    "block area section zone list item items link links group panel header head body form button buttons icon icons "
    "message text inline mobile desktop sticky fixed reader readers user users post article blog entry side".split()
)


def _is_noise(label: str) -> bool:
    """Whether one of the names (class tokens, id, role) is that of a part around the text: noise words and places only."""
    for name in label.lower().split():
        parts = [p for p in re.split(r"[-_\d]+", name.replace("side-bar", "sidebar")) if p]
        if any(_NOISE.fullmatch(p) for p in parts) and all(p in _PLACE or _NOISE.fullmatch(p) for p in parts):
            return True
    return False



@dataclass
class Block:
    path: str
    text: str
    noise: bool
    main: bool
    other: bool = False  # in an article that by its name is not the page's own
    aside: bool = False  # noise by its elements, whatever their names


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    styles: dict[str, list] = field(default_factory=dict)


@dataclass
class _Open:
    tag: str
    path: str
    noise: bool
    main: bool
    mute: bool = False  # inline noise: its text is dropped without ending the block
    other: bool = False
    aside: bool = False
    children: list[str] = field(default_factory=list)


def _below(path: str, kind: str) -> str:
    """The path of an element: the middle of long ones stands as a hash."""
    if len(path) > PATH_CHARS:
        from xxhash import xxh64_hexdigest

        head = path[: max(path.rfind("/", 0, PATH_HEAD), 0)]
        path = f"{head}/~{xxh64_hexdigest(path[len(head) :])}"
    return f"{path}/{kind}"


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def parse(source: str) -> Page:
    """Blocks of text in page order, and for each path the child sequences that the page shows there.

    Takes any text; unclosed and stray tags are put right as browsers do in the common cases.
    """
    page, stack, buffer = Page(), [_Open("", "", False, False)], []

    def flush() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                top = next(o for o in reversed(stack) if o.tag not in INLINE)
                page.blocks.append(Block(top.path, text, stack[-1].noise, stack[-1].main, stack[-1].other, stack[-1].aside))

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag not in INLINE:
                flush()
                page.styles.setdefault(stack[-1].path, []).append(tuple(stack[-1].children))
            stack.pop()

    def find(names, stop=()) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                return i
            if stack[i].tag in stop:
                return None
        return None

    at = 0
    while m := _TAG.search(source, at):
        if m.start() > at and not stack[-1].mute:
            buffer.append(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                buffer.append(" ")
            elif (i := find({tag})) is not None:
                close(i)
            continue
        if tag in VOID:
            if tag == "br":
                buffer.append(" ")
            elif tag not in INLINE:
                flush()
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSED_BY_SAME and (i := find({tag}, ("table", "ul", "ol", "dl", "select"))) is not None:
                close(i)
            if (i := find(CLOSED_BY_BLOCK, ("table", "button", "article", "section", "div", "td", "li"))) is not None:
                close(i)
        up = stack[-1]
        names = {}
        if m[3]:
            names = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(m[3])}
        label = " ".join(filter(None, (names.get("class"), names.get("id"), names.get("role"))))
        kind = tag + "".join("." + c for c in (names.get("class") or "").split())
        if tag not in INLINE:
            up_block = next(o for o in reversed(stack) if o.tag not in INLINE)
            up_block.children.append(kind)
            path = _below(up_block.path, kind)
        else:
            path = up.path
        aside = tag in ASIDE or (tag == "header" and not up.main) or "hidden" in names
        noise = aside or bool(label and tag not in ("html", "body") and tag not in MAIN and _is_noise(label))
        other = up.other or bool(tag == "article" and label and _is_noise(label))
        mute = up.mute or (noise and tag in INLINE)
        main = up.main or tag in MAIN or names.get("role") == "main"
        stack.append(_Open(tag, path, up.noise or noise, main, mute, other, up.aside or aside))
        if m[3].endswith("/") and tag in INLINE:
            stack.pop()
    if at < len(source):
        buffer.append(source[at:])
    flush()
    close(1)
    page.styles.setdefault("", []).append(tuple(stack[0].children))
    return page


def shapes(page: Page) -> dict[str, tuple]:
    """What each path shows on the page, whatever the words: the child sequences, and the length of its text in steps."""
    words: dict[str, int] = {}
    for b in page.blocks:
        words[b.path] = words.get(b.path, 0) + len(b.text.split())
    return {path: (shown, words.get(path, 0) // LENGTH_STEP) for path, shown in page.styles.items()}


def text_blocks(page: Page) -> list[Block]:
    """The blocks that markup itself does not set aside: those of articles, if there are any.

    Articles that are comments, teasers and the like by their name are left out where other text stands. Where
    names alone would leave nothing, they are not heeded.
    """
    blocks = [b for b in page.blocks if not b.noise] or [b for b in page.blocks if not b.aside]
    blocks = [b for b in blocks if not b.other] or blocks
    return [b for b in blocks if b.main] if any(b.main for b in blocks) else blocks


def main_text(page: Page, low: frozenset[str] = frozenset(), fixed: frozenset[str] = frozenset(), names: bool = True) -> str:
    """The page's main text without the paths in ``low`` (texts that pages repeat) and ``fixed`` (branches of one shape).

    In articles the markup itself says that a branch is the page's own: only ``low`` counts there. Headings of an
    article stay beside its text, however often a site reuses their words, and no heading goes for its shape.
    Where all would go, ``fixed`` and then ``low`` are not heeded. Without ``names`` the tree alone decides:
    elements, class names and articles are not looked at.
    """
    blocks = text_blocks(page) if names else page.blocks

    def kept(b: Block, fixed: frozenset[str]) -> bool:
        heading = names and HEADING.search(b.path)
        if b.path in low and not (heading and b.main):
            return False
        return b.path not in fixed or bool(heading) or (names and b.main)

    for paths in (fixed, frozenset()):
        if any(b.path not in low and kept(b, paths) for b in blocks):
            blocks = [b for b in blocks if kept(b, paths)]
            break
    return " ".join(b.text for b in blocks)


#: What a page shows at a path: a shape, a text, or that there is text.
SHAPE, TEXT, ANY_TEXT = 0, 1, 2


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shapes and texts by path of each content that this task meets on a host, and the pages that hold it.

    Where pages of one content differ in other parts, the one of the lowest hash speaks for them.
    """
    from xxhash import xxh64_intdigest

    shown = pa.struct([("path", pa.string()), ("kind", pa.int8()), ("value", pa.int64())])
    schema = pa.schema([("host", pa.string()), ("print", pa.int64()), ("n", pa.int64()), ("order", pa.int64()), ("shown", pa.list_(shown))])
    kept: dict[tuple, list] = {}
    size = 0

    def signed(data: str) -> int:
        return int(np.uint64(xxh64_intdigest(data)).view(np.int64))

    def flush() -> pa.RecordBatch:
        host, content = zip(*kept, strict=True)
        n, order, features = zip(*kept.values(), strict=True)
        starts = np.cumsum([0, *map(len, features)])
        path, kind, value = zip(*[x for f in features for x in f], strict=True) if starts[-1] else ((), (), ())
        flat = pa.StructArray.from_arrays([pa.array(path, pa.string()), pa.array(kind, pa.int8()), pa.array(value, pa.int64())], fields=list(shown))
        cols = [pa.array(host), pa.array(content, pa.int64()), pa.array(n, pa.int64()), pa.array(order, pa.int64())]
        return pa.record_batch([*cols, pa.ListArray.from_arrays(pa.array(starts, pa.int32()), flat)], schema)

    for batch in batches:
        for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            host = host_of(url)
            if not host or not source:
                continue
            page = parse(source)
            key = host, signed(repr([(b.path, b.text) for b in text_blocks(page)]))
            seen = {(path, SHAPE, signed(repr(shown))) for path, shown in shapes(page).items()}
            seen |= {(b.path, TEXT, signed(b.text)) for b in page.blocks}
            seen = sorted(seen | {(b.path, ANY_TEXT, 0) for b in page.blocks})
            order = signed(repr(seen))
            before = kept.get(key)
            if before is None:
                kept[key] = [1, order, seen]
                size += len(seen)
            else:
                before[0] += 1
                if order < before[1]:
                    before[1:] = order, seen
            if size > FLUSH:
                yield flush()
                kept.clear()
                size = 0
    if kept:
        yield flush()


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host and path: pages, contents (pages without copies), presentation, content, branch, shape and
    importance; the numbers but the counts are 0 to 1.

    presentation: 1 - exp(-H), H the entropy of the path's shapes; e^H is the number of shapes in common use, which does
    not change with the number of pages. content: 1 minus the mean over the path's distinct texts of ln(contents that
    hold it) / ln(contents); null where no text stands. The frame: the elements shared by all paths of text that half the
    host's contents show. branch: the path's first element below the frame; elements of the frame, and a sole such path, are
    branches of their own. shape: the largest presentation in the branch. importance: content times shape; the shape
    where no text stands. With one content there is no evidence: all are 1.
    """
    c = F.col
    source = pages.select(c(url_col).cast("string").alias("url"), c(html_col).cast("string").alias("html"))
    shown = "array<struct<path: string, kind: tinyint, value: bigint>>"
    found = source.mapInArrow(_features, f"host string, print bigint, n bigint, order bigint, shown {shown}")
    found = found.groupBy("host", "print").agg(F.sum("n").alias("copies"), F.min(F.struct("order", "shown")).alias("first"))
    found = found.select("host", "copies", F.inline("first.shown")).groupBy("host", "path", "kind", "value").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("n")
    )
    style, text, log_n = c("kind") == SHAPE, c("kind") == TEXT, F.ln("n")
    nodes = found.groupBy("host", "path").agg(
        F.sum(F.when(style, c("copies"))).alias("pages"),
        F.sum(F.when(style, c("n"))).alias("contents"),
        F.sum(F.when(style, c("n") * log_n)).alias("spread"),
        F.avg(F.when(text, log_n)).alias("repeated"),
        F.sum(F.when(c("kind") == ANY_TEXT, c("n"))).alias("with_text"),
    )
    scale = F.ln("contents")
    part = lambda x: F.when(c("contents") > 1, x).otherwise(F.lit(1.0))
    nodes = nodes.select(
        "host", "path", "pages", "contents", part(F.greatest(F.lit(0.0), 1 - F.exp(c("spread") / c("contents") - scale))).alias("presentation"),
        F.when(c("repeated").isNotNull(), part(1 - c("repeated") / scale)).alias("content"), F.split("path", "/").alias("steps"), "with_text",
    )
    nodes = landed(nodes, "style-tree")  # read several times below: without it the pages would be parsed as often
    common = nodes.join(nodes.filter(c("path") == "").select("host", c("contents").alias("of_host")), "host")
    common = common.filter(2 * c("with_text") >= c("of_host"))
    # The elements that the first and the last of sorted paths share are those that all of them share.
    frame = common.groupBy("host").agg(F.min("steps").alias("lo"), F.max("steps").alias("hi"))
    apart = F.expr("array_position(zip_with(lo, hi, (a, b) -> coalesce(a = b, false)), false)")
    shared = F.when(apart > 0, apart - 1).otherwise(F.size("lo") - 1)
    nodes = nodes.join(frame.select("host", shared.cast("int").alias("depth")), "host", "left")
    nodes = nodes.withColumn("branch", F.array_join(F.slice("steps", 1, F.coalesce("depth", F.lit(0)) + 1), "/"))
    branches = nodes.groupBy("host", "branch").agg(F.max("presentation").alias("shape"))
    nodes = nodes.join(branches, ["host", "branch"])
    importance = part(F.coalesce("content", F.lit(1.0)) * c("shape")).alias("importance")
    return nodes.select("host", "path", "pages", "contents", "presentation", "content", "branch", "shape", importance)


def low_paths(tree: DataFrame, threshold: float = THRESHOLD, repeated: float = REPEATED, evidence: int = EVIDENCE) -> DataFrame:
    """(host, low, fixed): the text paths of each host that matter too little: those whose texts repeat, and those
    that do for the shape of their branch."""
    few = tree.filter((F.col("importance") < threshold) & (F.col("contents") >= evidence) & F.col("content").isNotNull())
    repeats = F.col("content") < repeated
    few = few.groupBy("host").agg(
        F.collect_list(F.when(repeats, F.col("path"))).alias("low"), F.collect_list(F.when(~repeats, F.col("path"))).alias("fixed")
    )
    return few.select("host", F.array_sort("low").alias("low"), F.array_sort("fixed").alias("fixed"))


def _extract(schema: pa.Schema, names: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            sets: dict[tuple, frozenset] = {}
            for source, *paths in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                keys = [tuple(p or ()) for p in paths]
                texts.append(main_text(parse(source or ""), *[sets.setdefault(k, frozenset(k)) for k in keys], names=names))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            cols = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.record_batch([x.cast(t) for x, t in zip(cols, schema.types, strict=True)], schema)

    return run


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", names: bool = True) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page. Without ``names`` the tree alone decides.

    Null or empty html gives empty text. Pages without a host are read without a tree. Repeated rows are each
    extracted. Two passes read the pages: one for the tree, one for the texts;
    hosts meet their few low paths in a join.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    c = F.col
    # Written out, the low paths have a size that Spark knows when it plans the join: a small table is broadcast,
    # so that pages stay where they are; a large one costs a shuffle by host.
    low = landed(low_paths(style_tree(pages, url_col, html_col)), "low-paths")
    source = pages.select(c(id_col).alias("page_id"), c(url_col).cast("string").alias("url"), c(html_col).cast("string").alias("html"))
    joined = source.withColumn("host", _host(c("url"))).join(low, "host", "left").select("page_id", "url", "html", "low", "fixed")
    ddl = f"page_id {source.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"
    return joined.mapInArrow(_extract(to_arrow_schema(StructType.fromDDL(ddl)), names), ddl)


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``. Null html gives empty text, a null or odd url a page without a tree."""
    return extract(table(spark, sf_dir, "pages"))

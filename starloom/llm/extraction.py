"""Main-text extraction with a site style tree (op2).

The DOMs of all pages of a host are merged into one tree whose nodes are *style paths*: tags with their class and id, from the
body down. Each node gathers how its pages present it (the sequence of its children's styles) and what they put there
(the texts of its blocks). Noise looks alike on many pages: a block text that appears on n of a node's m pages has the entropy
log n / log m, and a node's content importance is one less the mean entropy of its distinct block texts. The
importance of a node combines the entropy of its presentation with the content importance of its subtree, damped by
``GAMMA`` as in the literature. Nodes that few pages of their host have are judged in the tree of all hosts.

Style names carry a prior: what is plainly named as navigation, footer, sidebar, advert, form or reader comment keeps so little of its
importance that the name alone decides. Names that text has, too (header, notice, related, discussion and the like, ``AMBIGUOUS_NAMES``), take a
tenth: such a branch stays if nearly all its texts differ from page to page, and goes where no tree has enough pages to tell. A header
inside a landmark is content. The landmarks ``article`` and ``main`` and what lies in them keep all of it, unless they lie in a branch with
a name of noise themselves (a teaser in a sidebar, a reader's comment): those are judged like any other. What stands beside a landmark is
judged by the tree, too. Branches below the threshold are cut from every page of the host. Plain text tags without a name are
never cut for their content alone.

A tree counts distinct pages: those of a host (or, in the tree of all hosts, of any) whose blocks outside noise names are
the same are one page, so an article that is copied on many pages stays. Statistics cover all pages and are combined before
the shuffle, so a host with a third of all pages, or a page with as many copies, is only partial results. The list of cut
branches is joined to the pages by host: broadcast if its size is proven small, else as a
shuffle join that splits hot hosts. Pages are parsed one by one; each is read whole.

Defined cases: null or empty html gives an empty text; a null URL or one without ``://`` belongs to the host ''; repeated rows count
as one page and get the same text; unclosed tags, comments and scripts end with the page; an empty table gives
an empty result.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import cut_lineage, load, slices, small_side

#: Share of a subtree's content in a node's importance; the rest is its own presentation.
GAMMA = 0.9
#: Branches of less importance are cut.
LEAST_IMPORTANCE = 0.7
#: Importance that a name of noise leaves.
NOISE_FACTOR = 0.3
#: Importance that an ambiguous name leaves.
AMBIGUOUS_FACTOR = 0.9
#: A host's own tree judges a node that at least so many of its pages have.
LEAST_PAGES = 8

#: Fixed values of HTML.
RAW = frozenset({"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"})
BLOCK = frozenset({
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"})
SPACED = frozenset({"br", "td", "th", "img", "input", "button", "select"})
#: Elements that a start tag of the key ends if one is open (and nothing that holds blocks lies between).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
HOLDERS = frozenset({"ul", "ol", "dl", "table", "select", "div", "section", "article", "main", "body", "td", "th", "blockquote"})
#: Never part of a text.
DROPPED = frozenset({"head", "template", "svg", "math", "object", "audio", "video", "canvas", "select", "button", "datalist", "map"})
NOISE_TAGS = frozenset({"nav", "footer", "aside", "form", "dialog", "menu", "search"})
NOISE_NAMES = frozenset({
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "copyright", "discussion", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notification", "pager", "pagination", "popup", "privacy", "promo", "promotion", "recommended", "related", "replies",
    "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets"})
#: Those that also stand over text that differs on every page.
AMBIGUOUS_NAMES = frozenset({
    "banner", "copyright", "discussion", "header", "masthead", "menu", "notice", "notification", "privacy", "promo", "promotion", "recommended",
    "related", "respond", "search", "share", "sharing", "social", "widget", "widgets"})
LANDMARKS = frozenset({"article", "main"})

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![-\w:.])(hidden)(?![-\w:.])""")
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_NAMES = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")
_LONG_DIGITS = re.compile(r"\d{3,}")


def _style(tag: str, attributes: str) -> tuple[str, str, bool, bool]:
    """A tag's style label, whether its name means noise (``!``), may mean it (``?``), means a header (``h``) or neither (empty),
    whether it is a landmark, and whether it is hidden."""
    noise, hidden, label, landmark, words = tag in NOISE_TAGS, False, tag, tag in LANDMARKS, {"header"} if tag == "header" else set()
    if attributes and attributes != "/":
        for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if bare or name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                hidden = True
            elif name in ("class", "id"):
                # Running numbers are one style: all digits of an id, long ones of a class.
                label += "#" + _DIGITS.sub("0", value) if name == "id" else "." + _LONG_DIGITS.sub("0", "-".join(value.split()))
                words |= NOISE_NAMES.intersection(_NAMES.split(value))
            elif name == "role":
                noise = noise or value in ("navigation", "banner", "contentinfo", "search", "complementary", "form", "dialog", "alert")
                landmark = landmark or value in ("main", "article")
    kind = "!" if noise or words - AMBIGUOUS_NAMES else "?" if words - {"header"} else "h" if words else ""
    return label, kind, landmark and not kind, hidden


_STYLES: dict[tuple[str, str], tuple] = {}


class _Node:
    __slots__ = ("tag", "path", "noise", "inside", "below_noise", "dropped", "children", "named")

    def __init__(self, tag, path, noise, inside, below_noise, dropped, named):
        self.tag, self.path, self.noise, self.inside, self.dropped, self.named = tag, path, noise, inside, dropped, named
        self.below_noise = below_noise
        self.children = []


def parse(text: str) -> tuple[list[tuple[str, bool, str]], list[tuple[str, str]]]:
    """A page's blocks in order as (style path, inside a landmark, text), and its nodes as (style path, styles of
    the children in order, repeats joined). Paths run over containers; noise by name carries a leading ``!`` or ``?`` in its part, a
    landmark a leading ``@``."""
    root = _Node("html", "", "", False, False, False, True)
    stack, nodes, blocks, parts = [root], [root], [], []
    at, size = 0, len(text)

    def flush() -> None:
        if parts:
            block = _BLANKS.sub(" ", references.unescape("".join(parts))).strip(" ")
            parts.clear()
            if block:
                node = stack[-1]
                blocks.append((node.path, node.inside, block))

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    while at < size:
        m = _TOKEN.search(text, at)
        if m is None:
            if not stack[-1].dropped:
                parts.append(text[at:])
            break
        if m.start() > at and not stack[-1].dropped:
            parts.append(text[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:  # an end tag
            if tag in BLOCK or tag in DROPPED or tag in ("td", "th"):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k) if tag in BLOCK else stack.__delitem__(slice(k, None))
                        break
                else:
                    if tag == "p":
                        flush()
            if tag in SPACED:
                parts.append(" ")
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(text, at) if tag not in _RAW_ENDS else _RAW_ENDS[tag].search(text, at)
            at = end.end() if end else size
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            elif tag in SPACED:
                parts.append(" ")
            continue
        if tag not in BLOCK and tag not in DROPPED and tag not in ("td", "th"):
            continue  # inline
        if tag in BLOCK:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in HOLDERS:
                    break
        else:
            parts.append(" ")
        if tag in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[tag]:
                    close(k)
                    break
                if stack[k].tag in HOLDERS:
                    break
        key = (tag, attributes)
        style = _STYLES.get(key)
        if style is None:
            if len(_STYLES) > 20_000:
                _STYLES.clear()
            style = _STYLES[key] = _style(tag, attributes)
        label, noise, landmark, hidden = style
        top = stack[-1]
        if noise == "h":
            noise = "" if top.inside else "?"
        if tag in ("html", "body"):
            continue
        landmark = landmark and not top.below_noise
        part = noise + label if noise else f"@{label}" if landmark else label
        top.children.append(part)
        named = label != tag or noise or landmark or tag in ("div", "section", "header", "details", "table", "ul", "ol", "dl")
        path = f"{top.path}/{part}" if named else top.path
        node = _Node(tag, path, noise, top.inside or landmark, top.below_noise or bool(noise), top.dropped or hidden or tag in DROPPED, named)
        if attributes.endswith("/") and tag in DROPPED:
            continue
        stack.append(node)
        if named and not node.dropped:
            nodes.append(node)
    close(1)
    flush()
    shapes = [(n.path, ">".join(c for i, c in enumerate(n.children) if not i or c != n.children[i - 1])) for n in nodes]
    return blocks, shapes


_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}


def main_text(html: str | None, cut: frozenset[str] | set[str]) -> str:
    """The text of a page without the branches in ``cut``."""
    if not html:
        return ""
    blocks, _ = parse(html)
    verdict: dict[str, bool] = {}
    out = []
    for path, _, block in blocks:
        keep = verdict.get(path)
        if keep is None:
            parts, prefix, keep = path.split("/")[1:], "", True
            for part in parts:
                prefix += "/" + part
                if prefix in cut:
                    keep = False
                    break
            verdict[path] = keep
        if keep:
            out.append(block)
    return "\n".join(out)


def _host(url: F.Column) -> F.Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    return F.lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """host, page (a hash of the blocks outside noise names) and features, one row for each distinct page of a host. Features are
    structs of path, kind (n: node, s: presentation, t: block text) and a hash."""
    def gather(batches):
        for batch in slices(batches, 1):
            hashes, ends, paths, kinds, features = [], [0], [], [], []
            for text in batch.column(1).to_pylist():
                blocks, shapes = parse(text or "")
                rows = {(p, "t", hash64(t)) for p, _, t in blocks} | {(p, "s", hash64(s)) for p, s in shapes} | {(p, "n", 0) for p, _ in shapes}
                main = sorted({t for p, k, t in rows if k == "t" and "/!" not in p}) or sorted(rows)
                hashes.append(hash64(repr(main)))
                for p, k, f in sorted(rows):
                    paths.append(p)
                    kinds.append(k)
                    features.append(f)
                ends.append(len(paths))
            held = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(kinds, pa.string()), pa.array(features, pa.int64())],
                                              ["path", "kind", "feature"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)],
                                             ["host", "page", "features"])

    rows = pages.select(_host(F.coalesce("url", F.lit(""))).alias("host"), "html").mapInArrow(
        gather, "host string, page long, features array<struct<path: string, kind: string, feature: long>>")
    # Copies may differ in noise: the smallest is taken, so that any order of rows gives the same.
    return rows.groupBy("host", "page").agg(F.min("features").alias("features"))


def _merge(distinct: DataFrame, keys: list[str]) -> DataFrame:
    return (distinct.select(*keys, F.explode("features").alias("x")).groupBy(*keys, "x.path", "x.kind", "x.feature")
            .agg(F.count("*").alias("pages")))


def style_tree(pages: DataFrame) -> DataFrame:
    """The merged trees in rows: host, path, kind, feature and pages, the number of distinct pages that have it."""
    return _merge(distinct_pages(pages), ["host"])


def hash64(text: str) -> int:
    import hashlib
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _importance(tree: DataFrame, keys: list[str]) -> DataFrame:
    """Importance by ``keys`` and path: own presentation entropy, and the content of the subtree."""
    # With m pages, p of them having a feature, the entropies are sums over features of log p and p log p; so one
    # aggregate, combined before the shuffle, gives them, and a node with very many features is a few partial sums.
    text, style, p = F.col("kind") == "t", F.col("kind") == "s", F.col("pages")
    sums = tree.groupBy(*keys, "path").agg(
        F.max(F.when(F.col("kind") == "n", p)).alias("m"), F.count_if(text).alias("texts"),
        F.sum(F.when(text, F.log(p))).alias("logs"), F.sum(F.when(style, p)).alias("styles"),
        F.sum(F.when(style, p * F.log(p))).alias("style_logs")).where("m IS NOT NULL")
    log_m = F.log(F.greatest(F.col("m"), F.lit(2)))
    own = sums.select(
        *keys, "path", "m", "texts",
        ((F.col("styles") * F.log("m") - F.col("style_logs")) / (F.col("m") * log_m)).alias("presentation"),
        F.when(F.col("texts") > 0, F.greatest(F.col("texts") - F.col("logs") / log_m, F.lit(0.0))).alias("content"))
    # A node's subtree: every path is counted for all its prefixes.
    parts = F.split("path", "/")
    above = own.withColumn("top", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))
    subtree = above.groupBy(*keys, F.col("top").alias("path")).agg(F.sum("content").alias("content"), F.sum("texts").alias("texts"))
    return (own.select(*keys, "path", "m", F.coalesce("presentation", F.lit(0.0)).alias("presentation")).join(subtree, [*keys, "path"])
            .withColumn("importance", F.lit(1 - GAMMA) * F.least(F.col("presentation"), F.lit(1.0))
                        + F.lit(GAMMA) * F.when(F.col("texts") > 0, F.col("content") / F.col("texts")).otherwise(F.lit(1.0))))


def cut_branches(pages: DataFrame, least_importance: float = LEAST_IMPORTANCE) -> DataFrame:
    """host and ``cut``, the style paths of the host that are noise."""
    distinct = cut_lineage(distinct_pages(pages))
    by_host = _importance(_merge(distinct, ["host"]), ["host"])
    everywhere = _merge(distinct.groupBy("page").agg(F.min("features").alias("features")), [])
    common = _importance(everywhere, []).select("path", F.col("m").alias("all_m"), F.col("importance").alias("all_importance"))
    last = F.element_at(F.split("path", "/"), -1)
    judged = by_host.join(common, "path").where(F.col("path") != "").withColumn("last", last)
    importance = (F.when(F.col("m") >= LEAST_PAGES, F.col("importance"))
                  .when(F.col("all_m") >= LEAST_PAGES, F.col("all_importance")).otherwise(F.lit(1.0)))
    noise, ambiguous = F.col("last").startswith("!"), F.col("last").startswith("?")
    known = (F.col("m") >= LEAST_PAGES) | (F.col("all_m") >= LEAST_PAGES)
    landmark = F.col("last").startswith("@")
    inside = F.contains("path", F.lit("/@"))
    final = (F.when(noise | (ambiguous & ~known), importance * NOISE_FACTOR).when(ambiguous, importance * AMBIGUOUS_FACTOR)
             .when(inside, F.lit(1.0)).otherwise(importance))
    # A branch that holds a landmark is not cut for its own sake.
    holds = judged.where(landmark).select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(F.split("path", "/"))), lambda n: F.array_join(F.slice(F.split("path", "/"), F.lit(1), n), "/"))).alias("path")).distinct()
    low = judged.where(final < least_importance)
    return (low.join(holds, ["host", "path"], "left_anti").unionByName(low.where(noise)).select("host", "path").distinct()
            .groupBy("host").agg(F.collect_set("path").alias("cut")))


def extract_text(pages: DataFrame, least_importance: float = LEAST_IMPORTANCE) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    cut = cut_lineage(cut_branches(pages, least_importance))
    joined = (pages.select("page_id", "url", "html", _host(F.coalesce("url", F.lit(""))).alias("host"))
              .join(small_side(cut), "host", "left").select("page_id", "url", "cut", "html"))

    def extract(batches):
        for batch in slices(batches, 3):
            texts = [main_text(h, frozenset(c or ())) for c, h in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")


def op2_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(load(spark, sf_dir, "pages"))


#: Entropies of parsed trees: no SQL. Tests compare texts with a separate parser's on fixed pages.
SQL = None

"""Main text of web pages by a site style tree.

Every page is read into a tree of elements; an element's key is the path of tags with the words of class and id
that have no digit (post, but not the number of the post). The trees of a host's pages are merged by
aggregates: per element, how often each sequence of child elements (its presentation) and each text of a leaf (its content) occurs. The
presentation importance of an element is the entropy of its presentations, the content importance of a leaf the entropy of its texts, both over
the pages that have it and scaled to 0 .. 1; a branch is as important as its most important leaf, with its own presentation
weighing ``STYLE``. Branches of low importance, which look and read alike on the pages of a site, are removed from each page; the root and
the body never go as a whole. Pages of a host with the same text count once.

An element that few pages have cannot be judged. What a page marks up as its article or main part is judged like the rest, ``PRIOR`` more
important. If that part holds at least half of the text that is left, of the rest only branches that were judged and found of high importance stay;
otherwise, as on a page with a small teaser in an article element, it does not count. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments of readers that are marked by element, role, class
or id are left out on every page. A class or id counts if all words of one of its tokens are such names (cookie-notice, but not no-sidebar). It never
marks html, body, article or main, nor an element that holds a main element, the first article, or most of the text of a page without these.

The statistics are counted with a map-side combine by host, element and value, so a host with a third of all pages is no hot task.
Only its elements of low importance, and of high importance beside articles, are joined back, a few for each host, by a join that adaptive execution can split.

Defined cases: null html is empty; a null url has the host of the empty string; repeated rows each give a row; an empty table gives no rows.
Unclosed elements are closed by their parents, or by the next block of the same kind; an unfinished tag or comment at the end is dropped.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import quoted, stored

#: Pages that must have an element before it is judged, the importance below which its branch goes, the weight of presentation.
PAGES, LEAST, STYLE = 5, 0.3, 0.1
#: What an article or main element adds to importance, and the importance from which a branch beside it stays.
PRIOR, HIGH = 0.15, 0.7
#: Levels of the tree that are judged as branches of their own; what is deeper counts to its ancestors there.
LEVELS = 12

#: Fixed values of HTML: elements without content, with raw text, that begin a block, and that a block closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCKS - {"br", "button", "option", "select", "caption", "body", "html", "head"}
#: Elements, roles and words of class and id that name parts of a page beside its article.
ASIDE = frozenset("nav header footer aside form head select button menu dialog svg canvas object audio video".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu nav "
    "navbar navigation newsletter notice notices pagination popup promo promoted related share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "topbar widget".split())
LANDMARKS = frozenset(["article", "main"])
#: A class or id marks no element that holds more than this part of the text of a page without landmarks.
MOST = 0.75
#: Elements that are the page itself; the root has no name.
WHOLE = frozenset(["", "html", "body"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[a-zA-Z/][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def blocks_of(html: str) -> list[tuple[str, str, bool, bool]]:
    """(path, text, aside, landmark) of every block of text in page order. A path has one part for each level."""
    stack: list[tuple[str, str, bool, bool, int]] = [("", "", False, False, -1)]  # tag, path, aside, landmark, innermost element marked by class or id
    out: list[tuple[str, str, bool, bool, int]] = []
    outer: list[int] = []  # of every marked element the next marked one around it
    holds: list[bool] = []  # whether it holds a landmark
    landmarks = False
    parts: list[str] = []
    place = stack[0]

    def flush() -> None:
        text = "".join(parts)
        parts.clear()
        if "&" in text:
            text = entities.unescape(text)
        text = " ".join(text.split())
        if text:
            out.append((place[1], text, *place[2:]))

    def pop_to(depth: int) -> None:
        del stack[depth:]

    at, size = 0, len(html)
    while at < size:
        found = TOKEN.search(html, at)
        end = size if found is None else found.start()
        if end > at:
            if not parts:
                place = stack[-1]
            parts.append(html[at:end])
        if found is None:
            break
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                parts.append(entities.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        closing = found[1] or found[4]
        block = tag in BLOCKS or tag in RAW
        if block or stack[-1][0] in RAW:
            flush()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if not block and any(s[0] in BLOCKS for s in stack[depth + 1:]):
                        break  # an inline end does not close blocks
                    pop_to(depth)
                    break
            continue
        ends = SELF_CLOSING.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in ends:
                    pop_to(depth)
                elif stack[depth][0] in BLOCKS and not any(s[0] in ends for s in stack[depth + 1:]):
                    break
        if tag in VOID:
            continue
        attributes = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(found[3] or found[6] or "")}
        tokens = [re.findall(r"[a-z0-9]+", t) for t in (attributes.get("class", "") + " " + attributes.get("id", "")).split()]
        words = {w for t in tokens for w in t}
        up = stack[-1]
        named = tag not in LANDMARKS | WHOLE and any(t and MARKS.issuperset(t) for t in tokens)
        mark = up[4]
        if named:
            mark = len(outer)
            outer.append(up[4])
            holds.append(False)
        beside = up[2] or tag in ASIDE or attributes.get("role", "") in ROLES
        if tag == "header" and up[3] and not named:
            beside = up[2]  # the heading of an article
        if tag in LANDMARKS and not beside:
            if mark >= 0 and (tag == "main" or not landmarks):
                holds[mark] = True
            landmarks = True
        landmark = up[3] or tag in LANDMARKS
        if block:
            name = tag + "".join("." + w for w in sorted(words) if not any(c.isdigit() for c in w))
            stack.append((tag, f"{up[1]}/{name}" if up[1].count("/") < LEVELS else up[1], beside, landmark, mark))
        else:
            stack.append((tag, up[1], beside, landmark, mark))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = size if end is None else end.end()
            pop_to(len(stack) - 1)
    flush()
    size = [0] * len(outer)
    for b in out:
        if b[4] >= 0 and not b[2]:
            size[b[4]] += len(b[1])
    most = MOST * sum(len(b[1]) for b in out if not b[2])
    for k in range(len(outer) - 1, -1, -1):
        if outer[k] >= 0:
            size[outer[k]] += size[k]
            holds[outer[k]] |= holds[k]
    marked: list[bool] = []
    for k, around in enumerate(outer):
        marked.append((around >= 0 and marked[around]) or not (holds[k] or (not landmarks and size[k] > most)))
    return [(path, text, aside or (mark >= 0 and marked[mark]), landmark) for path, text, aside, landmark, mark in out]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/?#:]*)", 1))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def style_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to (host, page, path, kind, value): per page and element its presentation, per page and leaf its content."""
    for batch in batches:
        rows: list[tuple[str, int, str, str, int]] = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            children: dict[str, list[str]] = {}
            leaves: dict[str, list[str]] = {}
            found = [b for b in blocks_of(html or "") if not b[2]]
            page = _hash("\n".join(b[1] for b in found))
            for path, text, _, _ in found:
                leaves.setdefault(path, []).append(text)
                parts = path.split("/")
                for i in range(1, len(parts)):
                    children.setdefault("/".join(parts[:i]), []).append(parts[i])
            for path, names in children.items():
                rows.append((host, page, path, "style", _hash(" ".join(names))))
            for path, texts in leaves.items():
                rows.append((host, page, path, "content", _hash("\n".join(texts))))
        columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string()),
             pa.array(columns[4], pa.int64())], ["host", "page", "path", "kind", "value"])


def importance(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(host, path, importance, pages) of every element that enough pages of its host have."""
    own = pages.select(host_of(F.col(quoted(url))).alias("host"), F.col(quoted(html)).cast("string").alias("html"))
    records = own.mapInArrow(style_records, "host string, page bigint, path string, kind string, value bigint").distinct()
    counts = records.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    spread = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")).otherwise(1.0)
    spread = stored(spread.select("host", "path", "kind", "m", entropy.alias("entropy")), "elements")
    content = spread.where("kind = 'content'")
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    branches = content.select("host", F.explode(above).alias("path"), "m", "entropy").groupBy("host", "path").agg(
        F.max("entropy").alias("content"), F.max("m").alias("m"))
    styles = spread.where("kind = 'style'").select("host", "path", F.col("entropy").alias("style"))
    both = branches.join(styles, ["host", "path"], "left")
    value = F.when(F.col("style").isNull(), F.col("content")).otherwise(STYLE * F.col("style") + (1 - STYLE) * F.col("content"))
    return both.where(F.col("m") >= PAGES).select("host", "path", value.alias("importance"), F.col("m").alias("pages"))


def main_text(html: str, low: frozenset[str], high: frozenset[str] = frozenset()) -> str:
    """The text of the page without marked parts and branches in low; of a page that is mostly an article, the article and branches in high."""
    found = [b for b in blocks_of(html) if not b[2]]
    if low:
        kept = []
        for b in found:
            parts = b[0].split("/")
            if not any("/".join(parts[:i]) in low for i in range(1, len(parts) + 1) if parts[i - 1].split(".")[0] not in WHOLE):
                kept.append(b)
        found = kept
    if 2 * sum(len(b[1]) for b in found if b[3]) >= sum(len(b[1]) for b in found):
        found = [b for b in found if b[3] or b[0] in high]
    return " ".join(b[1] for b in found)


def extract_text(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", least: float = LEAST) -> DataFrame:
    """Per page: id, url, ``text``, ``n_chars``."""
    judged = importance(pages, url, html).withColumn("inside", F.col("path").rlike("/(article|main)(\\.|/|$)"))
    low = F.col("importance") + F.when(F.col("inside"), PRIOR).otherwise(0.0) < least
    judged = judged.withColumn("low", low).where(F.col("low") | ((F.col("importance") >= HIGH) & ~F.col("inside")))
    by_host = judged.groupBy(F.col("host").alias("_host")).agg(
        F.collect_set(F.when(F.col("low"), F.col("path"))).alias("_low"), F.collect_set(F.when(~F.col("low"), F.col("path"))).alias("_high"))
    own = pages.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(url)).alias("url"), F.col(quoted(html)).cast("string").alias("html"),
                       host_of(F.col(quoted(url))).alias("host"))
    joined = own.join(by_host, F.col("host") == F.col("_host"), "left").select("id", "url", "html", "_low", "_high")
    kind = pages.schema[id_column].dataType.simpleString()
    link = pages.schema[url].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", frozenset(low or ()), frozenset(high or ())) for h, low, high in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = joined.mapInArrow(run, f"id {kind}, url {link}, text string, n_chars bigint")
    return rows.withColumnRenamed("id", id_column).withColumnRenamed("url", url)

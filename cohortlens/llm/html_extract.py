"""Operator 1: main text by wrapper induction over the pages of a host.

1. Every page becomes a tree of block elements.  Its *skeleton* merges like siblings (same tag,
   id and classes, digits masked), so lists and paragraphs of any length look alike.
2. A host's most frequent skeleton is its reference.  Each other skeleton is aligned with it by
   simple tree matching: roots of equal label match, and the children's best order-keeping
   matching adds up (dynamic programming).  Aligned nodes share a slot of the wrapper; a node
   without a partner gets a slot of its own path.
3. Texts are counted per (host, slot, text) over distinct pages, so copies don't vote.  Slots whose texts keep coming back across the
   host's pages are template; varying slots are content.
4. Text is read from the article or main element if there is one, else from the body, without
   elements that are furniture by tag, role, class or id, and without template slots.
   Inside an article, a name counts as a whole class, or as a longer class made of such names alone or naming
   comments; words of an id or of other classes only where the slot is repeated as well.  A form, or an element that has a name only as a part of a longer
   class or id, may also wrap the page: what stands in an article or main element below it (or in its
   paragraphs, if nothing else is left) is read if that is more than the rest.  In an article, other than that, only slots with one text on nearly all pages are template, never
   one that carries much of the host's text, so copies of an article stay content.

Counting is by partial aggregation on (host, slot, text), so a hot host is no hot task; page
content is read map-only, twice, next to a table of slot flags by content hash.

Cases: null or empty html gives empty text; a null url has the empty host; unclosed, misnested
or cut-off markup is read as far as it goes; elements deeper than ``DEPTH`` join their
ancestor's slot, but close and are judged as any other; repeated pages each give their row; extra input columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small
from .url_filter import host_and_path

DEPTH = 200
LEAST_PAGES = 5  # of a slot, before its texts can be called repeated
REPEATED = 0.5  # distinct texts per page of a slot, at most, to be template outside an article
CONSTANT = 0.9  # share of a slot's pages with one and the same text, to be template anywhere
MUCH = 0.2  # share of a host's text that a template slot stays under
SMALL_TABLE = 500_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var wbr br img ruby rt rp".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
FURNITURE_TAGS = frozenset("nav footer aside form button select option dialog menu svg canvas object audio video head input fieldset".split()) | RAW
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav navbar navigation topnav "
    "footer header masthead topbar breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login social share sharing related recommended recommendations comment comments commentlist disqus respond "
    "reply replies widget search pagination pager toc copyright legal disclaimer tags meta byline hidden".split())
COMMENTS = frozenset(("comment", "comments"))
COMMENT_IDS = COMMENTS | {"respond", "disqus_thread"}
PROMOTIONS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion newsletter subscribe subscription signup "
                       "cookie cookies consent gdpr share sharing social recommended recommendations".split())
FILLERS = frozenset("slot box unit bar block wrapper wrap container area inner banner notice popup widget buttons links form".split())
STATES = frozenset("no has with without is".split())  # a class that begins so tells of the page, not what the element is
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_NAMES = frozenset("article content main post entry story".split())
KEPT_TAGS = frozenset("html body article main".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                     "nav ol p pre section table ul".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                "option": {"option"}, "thead": {"tbody"}, "tbody": {"thead", "tbody"}}
STOPS = frozenset("table ul ol dl select article main section div body html".split())
NAME = re.compile(r"[a-z]+")
HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


class Block:
    """An open or closed block element."""

    __slots__ = ("tag", "path", "furniture", "main", "named", "certain")

    def __init__(self, tag: str, path: tuple, furniture: bool, main: bool, named: bool, certain: bool = False):
        self.tag, self.path, self.furniture, self.main, self.named = tag, path, furniture, main, named
        self.certain = certain  # furniture for another reason than a form or a part of a name above it


def compound(classes: set[str]) -> bool:
    """Whether a class of several words names a promotion or comments."""
    for name in classes:
        words = NAME.findall(name)
        if len(words) > 1 and words[0] not in STATES and (
                words[0] in COMMENTS or words[-1] in COMMENTS or PROMOTIONS & set(words) and set(words) <= PROMOTIONS | FILLERS):
            return True
    return False


def unseen(found: dict[str, str], attributes: str) -> bool:
    """Whether the attributes hide the element."""
    if "hidden" in found or found.get("aria-hidden") == "true" or HIDING.search(found.get("style", "")):
        return True
    return "hidden" in attributes.lower() and "hidden" in ATTRIBUTE.sub(" ", attributes).lower().replace("/", " ").split()


def opened(tag: str, attributes: str, parent: Block) -> Block:
    found = {a[0].lower(): html_lib.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    names = f"{found.get('id', '')} {found.get('class', '')}".lower()
    words = set(NAME.findall(names))
    role = found.get("role", "").lower()
    main = parent.main or tag in ("article", "main") or role in ("main", "article")
    classes = set(found.get("class", "").lower().split())
    certain = tag in FURNITURE_TAGS and tag != "form" or role in FURNITURE_ROLES or unseen(found, attributes)
    certain |= tag == "header" and not parent.main
    named = tag not in KEPT_TAGS and bool(words & FURNITURE_NAMES) and not words & MAIN_NAMES or bool(words & COMMENTS)
    certain |= tag not in KEPT_TAGS and bool(classes & FURNITURE_NAMES) and not words & MAIN_NAMES or bool(classes & COMMENTS)
    certain |= tag not in KEPT_TAGS and compound(classes)
    if main:  # an id is often made from a heading's words
        certain |= tag == "form" or found.get("id", "").lower() in COMMENT_IDS and tag not in HEADINGS
        furniture = certain
    else:
        furniture = certain or named or tag == "form"
    furniture |= parent.furniture
    certain |= parent.certain
    label = tag + re.sub(r"\d+", "0", "".join(f".{x}" for x in sorted(names.split())))
    return Block(tag, (*parent.path, label) if len(parent.path) < DEPTH - 1 else parent.path, furniture, main, parent.named or named, certain)


def blocks(page: str) -> Iterator[tuple[Block, str]]:
    """The page's texts in order, each with its block: white space is one space, references decoded."""
    stack, said = [Block("", (), False, False, False)], []

    def flush() -> list[tuple[Block, str]]:
        text = " ".join(html_lib.unescape("".join(said)).split())
        said.clear()
        return [(stack[-1], text)] if text else []

    def close(k: int) -> None:
        """Closes the open elements from the kth on."""
        count.subtract(b.tag for b in stack[k:])
        del stack[k:]

    def near() -> range:
        """The innermost open elements, among which an unclosed one is looked for."""
        return range(len(stack) - 1, max(0, len(stack) - 1 - DEPTH), -1)

    at, raw, count = 0, None, Counter()  # open elements by tag
    while at < len(page):
        if raw:  # up to the end tag, whatever stands there
            end = re.compile(rf"</{re.escape(raw)}(?=[\s/>])|</{re.escape(raw)}\Z", re.I).search(page, at)
            at, raw = end.start() if end else len(page), None
            continue
        m = TOKEN.search(page, at)
        said.append(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE:
                continue
            if count[tag]:
                yield from flush()
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
        elif tag in INLINE:
            said.append(" " if tag in ("br", "wbr") and tag == "br" else "")
        else:
            yield from flush()
            if tag in CLOSES_P:
                k = next((k for k in near() if stack[k].tag == "p" or stack[k].tag in STOPS), 0)
                if stack[k].tag == "p":
                    close(k)
            for k in near() if tag in SELF_CLOSING else ():
                if stack[k].tag in SELF_CLOSING[tag]:
                    close(k)
                    break
                if stack[k].tag in STOPS:
                    break
            if tag in VOID:
                continue
            stack.append(opened(tag, m[3], stack[-1]))
            count[tag] += 1
            if tag in RAW:
                raw = tag
    yield from flush()


def skeleton(paths: list[tuple]) -> tuple[list[list], dict[tuple, int]]:
    """The tree of all paths as [parent, label] rows in order, and each path's row."""
    rows, place = [[-1, ""]], {(): 0}
    for path in paths:
        for n in range(1, len(path) + 1):
            if path[:n] not in place:
                place[path[:n]] = len(rows)
                rows.append([place[path[: n - 1]], path[n - 1]])
    return rows, place


def describe(page: str | None) -> tuple[str, list[int], list[int]]:
    """(skeleton as text, hash of each node's own text or -1, its characters)."""
    found = list(blocks(page or ""))
    rows, place = skeleton([b.path for b, _ in found])
    said: list[list[str]] = [[] for _ in rows]
    for b, text in found:
        said[place[b.path]].append(text)
    return (json.dumps(rows, separators=(",", ":"), ensure_ascii=False), [zlib.crc32("\n".join(s).encode("utf-8", "replace")) if s else -1 for s in said],
            [sum(map(len, s)) for s in said])


def tree_match(page: list[list], reference: list[list]) -> dict[int, int]:
    """Simple tree matching: page node -> reference node."""
    def children(rows: list[list]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in rows]
        for k, (parent, _) in enumerate(rows[1:], 1):
            out[parent].append(k)
        return out

    below_a, below_b = children(page), children(reference)
    known: dict[tuple[int, int], tuple[int, list]] = {}

    def match(a: int, b: int) -> tuple[int, list]:
        """(matched nodes, chosen pairs of children)."""
        if (a, b) in known:
            return known[a, b]
        xs, ys = below_a[a], below_b[b]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs, 1):
            for j, y in enumerate(ys, 1):
                joint = best[i - 1][j - 1] + match(x, y)[0] if page[x][1] == reference[y][1] else 0
                best[i][j] = max(joint, best[i - 1][j], best[i][j - 1])
        i, j, pairs = len(xs), len(ys), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        known[a, b] = 1 + best[-1][-1], pairs
        return known[a, b]

    out, todo = {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        out[a] = b
        todo += match(a, b)[1]
    return out


def slots(skeleton_text: str, reference_text: str) -> list[int]:
    """Each node's slot in the host's wrapper: the reference node it matches, else a number from its path."""
    page, reference = json.loads(skeleton_text), json.loads(reference_text)
    matched = tree_match(page, reference)
    paths: list[str] = []
    for parent, label in page:
        paths.append(f"{paths[parent]}/{label}" if parent >= 0 else "")
    return [matched.get(k, (1 << 32) + zlib.crc32(paths[k].encode("utf-8", "replace"))) for k in range(len(page))]


def read_text(page: str | None, flags: str) -> str:
    """The page's main text; flags has 0 (content), 1 (repeated) or 2 (constant) for each skeleton node."""
    found = list(blocks(page or ""))
    _, place = skeleton([b.path for b, _ in found])
    has_main = any(b.main and not b.furniture for b, _ in found)
    kept, wrapped, paragraphs = [], [], []
    for b, text in found:
        at = place[b.path]
        flag = flags[at] if at < len(flags) else "0"
        if not b.furniture and flag != "2" and not (b.named and flag == "1") and (b.main or not has_main and flag == "0"):
            kept.append(text)
        elif b.furniture and not b.certain and flag != "2":  # below a form or a part of a name only
            if b.main:
                wrapped.append(text)
            elif flag == "0" and b.tag == "p" and not any(label.split(".")[0] == "form" for label in b.path):
                paragraphs.append(text)
    if not has_main and sum(map(len, wrapped)) > sum(map(len, kept)):
        kept = wrapped
    return " ".join(kept or paragraphs)


def describe_pages(pages: DataFrame) -> DataFrame:
    """(k, host, skel, hashes, chars) of every page; k is the content's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [host_and_path(u)[0] for u in batch.column(1).to_pylist()]
            skels, hashes, chars = zip(*(describe(p.as_py()) for p in batch.column(2))) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hosts, pa.string()), pa.array(skels, pa.string()),
                                              pa.array(hashes, pa.list_(pa.int64())), pa.array(chars, pa.list_(pa.int64()))],
                                             names=["k", "host", "skel", "hashes", "chars"])

    return pages.select("k", "url", "html").mapInArrow(run, "k long, host string, skel string, hashes array<bigint>, chars array<bigint>")


def align(skeletons: DataFrame) -> DataFrame:
    """(host, skel, slots) of distinct (host, skel, reference)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slots(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["host", "skel", "slots"])

    return skeletons.select("host", "skel", "reference").mapInArrow(run, "host string, skel string, slots array<bigint>")


def induce(seen: DataFrame) -> DataFrame:
    """(host, skel, flags) from described pages; pages of a host with the same texts in the same places count once."""
    copy = F.xxhash64("skel", "hashes")
    kinds = saved(seen.groupBy("host", "skel").agg(F.countDistinct(copy).alias("n")))
    reference = kinds.groupBy("host").agg(F.max_by("skel", F.struct("n", "skel")).alias("reference"))
    aligned = saved(align(kinds.join(reference, "host")))
    few = F.broadcast(aligned) if small(aligned, SMALL_TABLE // 10) else aligned
    distinct = seen.groupBy("host", copy.alias("copy")).agg(*[F.first(c).alias(c) for c in ("skel", "hashes", "chars")])
    texts = distinct.join(few, ["host", "skel"]).select("host", F.explode(F.arrays_zip("slots", "hashes", "chars")).alias("t")).where("t.hashes >= 0")
    counts = texts.groupBy("host", F.col("t.slots").alias("slot"), F.col("t.hashes").alias("hash")).agg(F.count("*").alias("n"), F.sum("t.chars").alias("chars"))
    stats = saved(counts.groupBy("host", "slot").agg(F.sum("n").alias("pages"), F.max("n").alias("most"), F.count("*").alias("kinds"), F.sum("chars").alias("chars")))
    whole = stats.groupBy("host").agg(F.sum("chars").alias("all_chars"))
    template = (F.col("pages") >= LEAST_PAGES) & (F.col("chars") < MUCH * F.col("all_chars"))
    judged = stats.join(whole, "host").select("host", "slot", F.when(template & (F.col("most") >= CONSTANT * F.col("pages")), "2").when(
        template & (F.col("kinds") <= REPEATED * F.col("pages")), "1").otherwise("0").alias("flag"))
    nodes = aligned.select("host", "skel", F.posexplode("slots").alias("at", "slot")).join(judged, ["host", "slot"], "left")
    rows = nodes.groupBy("host", "skel").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("flag", F.lit("0")).alias("flag")))).alias("f"))
    return rows.select("host", "skel", F.array_join("f.flag", "").alias("flags"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn(
        "k", F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))
    seen = saved(describe_pages(src))
    wrappers = saved(induce(seen))
    few = F.broadcast(wrappers) if small(wrappers, SMALL_TABLE // 10) else wrappers
    flags = saved(seen.join(few, ["host", "skel"]).groupBy("k").agg(F.min("flags").alias("flags")).where("flags rlike '[12]'"))
    flags = F.broadcast(flags) if small(flags, SMALL_TABLE) else flags
    flagged = src.join(flags, "k", "left").select("id", "url", "html", "flags")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [read_text(p.as_py(), f.as_py() or "") for p, f in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=["id", "url", "text", "n_chars"])

    out = flagged.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})

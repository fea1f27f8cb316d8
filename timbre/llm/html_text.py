"""HTML extraction: nearest-URL page differencing, with the page's structure.

A tokenizer walks the tags and yields the page's visible blocks as lines. Pages
are numbered in the order of host, path and id; a page's neighbours are those
numbered before and after it on its host, and of the two that with the longer
common path is taken, unless it is a copy (the same lines). The lines of both are
aligned by longest common subsequence and what they share is deleted. Only
digests of lines travel for that: pages are parsed once for the digests and again
for their text, which is exchanged once.

Structure decides where differencing can't: lines in elements that never hold
main text (menus, page headers, footers, sidebars, adverts, notices, forms,
reader comments) go even if no neighbour has them; lines in an ``article`` or
``main`` element, which the page itself declares to be content, stay even if a
neighbour has copied them; and where neighbours share more than half of a page's
other text, one of them is an edited copy of the other, so that lines of prose
(``PROSE`` words or more) stay. Scripts, styles and titles are never lines.

Edge cases: a null html or url is an empty one; a page without text gives the
empty string and 0; very long pages are lines like others; unclosed and stray
tags are closed by their parents or skipped; rows alike in all three columns
are one page; ties of host and path go by id, lines' digest and page digest; a null
``page_id`` is returned as null; an empty table gives an empty result; only
three columns are read. The result depends on the rows alone, not on partitions.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbre.llm.common import checkpointed, narrow
from timbre.operators.scoring import numbered

# Names of elements and words of class and id attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
DROPPED = frozenset("head script style noscript template iframe nav footer aside form button select option textarea svg canvas object audio video dialog menu title label fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTENT = frozenset(("article", "main"))
MARKED = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead topbar footer sidebar rail widget
cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login
comment comments commentlist disqus discussion replies respond related recommended share sharing social toolbar skip""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class names that mark content, against the ones above ("article-header" is content's own).
KEEPS = frozenset("article content main post story entry body text".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'>]+)""")
SPACES = re.compile(r"\s+")
#: A start tag of these closes an open element of the same sort.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCK_IN_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


@dataclass
class Element:
    name: str
    dropped: bool
    content: bool


#: Sorts of lines: declared to be content, in an element that never holds main text, neither.
CONTENT_LINE, MARKED_LINE, PLAIN_LINE = 0, 1, 2
#: Words of a line of prose.
PROSE = 12


@dataclass
class Line:
    text: str
    sort: int


@dataclass
class Page:
    lines: list[Line] = field(default_factory=list)

    def text(self, gone: frozenset[int] = frozenset()) -> str:
        return " ".join(x.text for i, x in enumerate(self.lines) if x.sort != MARKED_LINE and i not in gone)


def marked(name: str, attributes: str, content: bool) -> bool:
    """Whether class, id, role or hidden say that the element isn't main text."""
    if not attributes or name in ("html", "body"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        key = (m[1] or m[3]).lower()
        value = (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "role" and value in ROLES:
            return True
        if key in ("class", "id"):
            for name_ in value.split():
                words = re.split(r"[-_\d]+", name_)
                if not MARKED.isdisjoint(words) and (KEEPS.isdisjoint(words) or words[-1] in MARKED and not content):
                    return True
    return False


def blocks_of(source: str) -> Page:
    """The page's blocks in order, white space collapsed; text of dropped elements is in lines of its own."""
    page, stack = Page(), []
    parts, aside = [], []
    low = None

    def flush() -> None:
        for pieces, sort in ((parts, CONTENT_LINE if stack and stack[-1].content else PLAIN_LINE), (aside, MARKED_LINE)):
            text = SPACES.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                page.lines.append(Line(text, sort))
            pieces.clear()

    def pop(depth: int) -> None:
        if any(e.name not in INLINE for e in stack[depth:]):
            flush()
        del stack[depth:]

    at = 0
    while True:
        m = TAG.search(source, at)
        if not (stack and stack[-1].name in RAW):
            (aside if stack and stack[-1].dropped else parts).append(source[at : m.start() if m else len(source)])
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    pop(depth)
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break  # a stray inline end tag doesn't close blocks
            else:
                if name not in INLINE:
                    flush()
            continue
        closes = CLOSES.get(name, set()) | ({"p"} if name in BLOCK_IN_P else set())
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].name in closes:
                pop(depth)
                break
            if stack[depth].name not in INLINE and not (name in ("td", "th", "tr") and stack[depth].name in ("td", "th", "tr")):
                break
        above = stack[-1] if stack else None
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        content = bool(above and above.content) or name in CONTENT
        header = name == "header" and not (above and above.content)
        dropped = bool(above and above.dropped) or name in DROPPED or header or marked(name, m[3], content)
        if m[3].endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:  # up to its end tag all is text
            low = low or source.lower()
            if len(low) != len(source):
                low = source
            end = low.find(f"</{name}", at)
            at = len(source) if end < 0 else end
            stack.append(Element(name, True, content))
            continue
        stack.append(Element(name, dropped, content and not dropped))
    flush()
    return page


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Numbers of the lines of ``a`` on a longest common subsequence with ``b``."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(a) - head and tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = [*range(head), *range(len(a) - tail, len(a))]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    # only lines of both can be on it
    both = Counter(x) & Counter(y)
    xs, ys = [i for i, s in enumerate(x) if s in both], [s for s in y if s in both]
    if not xs or not ys:
        return sorted(found)
    masks: dict[str, int] = {}
    for j, s in enumerate(ys):
        masks[s] = masks.get(s, 0) | 1 << j
    full, row, rows = (1 << len(ys)) - 1, (1 << len(ys)) - 1, []
    for i in xs:
        hit = row & masks[x[i]]
        row = (row + hit | row - hit) & full
        rows.append(row)
    # back along the rows: zeros of a row are the ends of the subsequences found so far
    j = len(ys)
    for k in range(len(xs) - 1, -1, -1):
        ends = ~rows[k] & ((1 << j) - 1)
        before = ~rows[k - 1] & ((1 << j) - 1) if k else 0
        if ends.bit_count() > before.bit_count():
            found.append(head + xs[k])
            j = ends.bit_length() - 1
    return sorted(found)


def template_lines(mine: list[tuple[int, int, bool, int]], other: list[int]) -> list[int]:
    """Numbers of the lines (digest, sort, prose, size) that go because ``other`` has them too."""
    shared = common_lines([x[0] for x in mine], other)
    plain = [i for i in shared if mine[i][1] == PLAIN_LINE]
    copied = 2 * sum(mine[i][3] for i in plain) > sum(x[3] for x in mine if x[1] == PLAIN_LINE) and any(mine[i][2] for i in plain)
    return [i for i in shared if mine[i][1] == MARKED_LINE or mine[i][1] == PLAIN_LINE and not (copied and mine[i][2])]


SIGNED = np.dtype([("digest", "<u8"), ("sort", "u1"), ("prose", "?"), ("size", "<u4")])
SIGNED_SCHEMA = "page binary, page_id long, host string, path string, same long, signs binary"
LINES_SCHEMA = "page binary, page_id long, url string, lines binary"


def page_digests(batch: pa.RecordBatch) -> pa.Array:
    """128-bit digests of rows (page_id, url, html)."""
    rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
    return pa.array([xxhash.xxh3_128_digest(repr((i, u)).encode("utf-8", "surrogatepass") + b"\0" + (h or "").encode()) for i, u, h in rows], pa.binary())


def sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to the digests and sorts of their lines, and a digest of all lines."""
    for batch in batches:
        signs, same = [], []
        for source in batch.column(2):
            page = blocks_of(source.as_py() or "")
            rows = np.array([(xxhash.xxh3_64_intdigest(x.text), x.sort, x.text.count(" ") + 1 >= PROSE, min(len(x.text), 0xFFFFFFFF)) for x in page.lines], SIGNED)
            signs.append(rows.tobytes())
            same.append(xxhash.xxh3_64_intdigest(rows["digest"].tobytes()) - (1 << 63))
        yield pa.RecordBatch.from_arrays([page_digests(batch), batch.column(0), batch.column(3), batch.column(4), pa.array(same, pa.int64()), pa.array(signs, pa.binary())], names=[x.split()[0] for x in SIGNED_SCHEMA.split(", ")])


def line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to their lines, compressed for the exchange."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        lines = [press.compress(json.dumps([[x.text, x.sort] for x in blocks_of(h.as_py() or "").lines], ensure_ascii=False).encode()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([page_digests(batch), batch.column(0), batch.column(1), pa.array(lines, pa.binary())], names=[x.split()[0] for x in LINES_SCHEMA.split(", ")])


def difference_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for mine, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            gone.append(template_lines(np.frombuffer(mine, SIGNED).tolist(), np.frombuffer(other, SIGNED)["digest"].tolist()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["page", "gone"])


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        texts, shared = [], []
        for lines, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            page, gone = Page([Line(*x) for x in json.loads(unpress.decompress(lines))]), frozenset(gone or ())
            texts.append(page.text(gone))
            shared.append(len(gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(shared, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_shared"])


def common_steps(a: Column, b: Column) -> Column:
    """Leading steps that two paths have in common."""
    same = F.zip_with(F.split(a, "/"), F.split(b, "/"), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s["n"] + F.when(s["on"] & x, 1).otherwise(0)).alias("n"), (s["on"] & x).alias("on")))["n"]


def paired(signed: DataFrame) -> DataFrame:
    """(page, signs, near): pages with the lines' signs of their nearest neighbour; those without one are left out."""
    keys = signed.select("page", "page_id", "host", "path", "same").dropDuplicates(["page"])
    nth = checkpointed(numbered(keys, [F.col(c) for c in ("host", "path", "page_id", "same", "page")], "nth").select("nth", "page", "host", "path", "same"))
    near = nth.select(F.col("nth").alias("at"), F.col("host").alias("h"), F.col("path").alias("p"), F.col("same").alias("s"), F.col("page").alias("near"))
    both = nth.withColumn("side", F.explode(F.array(F.lit(-1), F.lit(1)))).join(near, (F.col("nth") + F.col("side") == F.col("at")) & (F.col("host") == F.col("h")) & (F.col("same") != F.col("s")))
    # a page has two rows at most; of equal ones the page before counts
    best = both.groupBy("page").agg(F.max_by("near", F.struct(common_steps(F.col("path"), F.col("p")), -F.col("side"))).alias("near"))
    signs = signed.select(F.col("page").alias("k"), "signs")
    out = best.join(signs.dropDuplicates(["k"]).withColumnRenamed("signs", "theirs"), F.col("near") == F.col("k")).select("page", "theirs")
    return out.join(signs.dropDuplicates(["k"]), F.col("page") == F.col("k")).select("page", "signs", F.col("theirs").alias("near"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: its main text, the text's length, and how many lines were deleted because a neighbour has them."""
    rows = narrow(pages, page_id="page_id", url="url", html="html")
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), "/+$", "")
    signed = checkpointed(rows.select("page_id", "url", "html", host.alias("host"), path.alias("path")).mapInArrow(sign_batches, SIGNED_SCHEMA))
    gone = paired(signed).mapInArrow(difference_batches, "page binary, gone array<int>").where("size(gone) > 0")
    lines = rows.mapInArrow(line_batches, LINES_SCHEMA)
    done = lines.join(gone.withColumnRenamed("page", "g"), F.col("page") == F.col("g"), "left")
    return done.select("page_id", "url", "lines", "gone").mapInArrow(text_batches, "page_id long, url string, text string, n_chars long, n_shared long")

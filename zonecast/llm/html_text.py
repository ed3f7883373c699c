"""Main text of web pages by differencing each page with its nearest neighbour.

Pages are ordered by host and URL path, and a page is paired with its nearest
neighbour on either side on the same host.  All text lines of a pair are
aligned by a longest common subsequence and what they share - menus, slogans,
notices of the site - is deleted.  Markup only settles conflicts: a line that
the page marks as its article (by element, or by a class word) stays though a
neighbour has it too, and a line inside an element that is furniture by its
tag, role or class goes though no neighbour has it.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.groups import column
from zonecast.llm.order import with_position
from zonecast.llm.shared import bounded, materialize

PLAIN, ARTICLE, FURNITURE, WORDED = 0, 1, 2, 3         # WORDED: inside an element that has an article's class word

# Tags, roles and class words (fixed values).  A class or id token is furniture if all its parts are furniture or neutral words, one at least the former.
_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot
    th thead title tr ul""".split())
_CONTAINERS = frozenset("""article aside body details dialog div dl fieldset figure footer form head header main menu nav ol search
    section table ul""".split())
_SKIPPED = frozenset("script style noscript template iframe select button textarea title".split())       # no text of the page, or of a form
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE_TAGS = frozenset("nav footer aside form menu dialog search head".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices outbrain
    overlay pager pagination paywall popup promo promotion related respond share sharing sidebar signup skip social sponsor
    sponsored subscribe subscription taboola toolbar topbar widget widgets""".split())
_NEUTRAL_WORDS = frozenset("""area article articles bar block box container entry inner items links list main post posts site slot stories
    story unit wrap wrapper""".split())
_ARTICLE_WORDS = frozenset("article entry story post".split())
_ARTICLE_TOKENS = frozenset("""articlebody article-body article-content article-text entry-content post-body post-content story-body
    story-content""".split())

_NOT_ARTICLES = frozenset("ad ads advert adverts advertisement comment comments related".split())      # exact tokens, also on <article>
_SHORT = frozenset("p h1 h2 h3 h4 h5 h6".split())        # these end at the next block
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
         "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"}}        # what ends an unclosed item

_MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_REST = re.compile(r"(?:[^'\">]|\"[^\"]*\"|'[^']*')*+")         # attributes, up to the end of the tag or a quote that never ends
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[^\W_]+")


def _furniture_token(token: str) -> bool:
    words = _WORD.findall(token)
    return not _FURNITURE_WORDS.isdisjoint(words) and all(w in _FURNITURE_WORDS or w in _NEUTRAL_WORDS or w.isdigit() for w in words)


def _kind_of(tag: str, attributes: str, inside: int) -> int:
    """What an element makes of its content, given what it stands in."""
    if inside == FURNITURE or tag in _FURNITURE_TAGS or (tag == "header" and inside not in (ARTICLE, WORDED)):
        return FURNITURE
    tokens: set[str] = set()
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            found = value.lower().strip("\"'").split()
            if name.lower() == "role" and _FURNITURE_ROLES.intersection(found):
                return FURNITURE
            tokens.update(found)
    if tag == "article" and tokens & _NOT_ARTICLES:
        return FURNITURE
    if tag not in ("body", "html", "article", "main") and any(map(_furniture_token, tokens)):
        return FURNITURE
    if tag in ("article", "main") or any("-".join(_WORD.findall(t)) in _ARTICLE_TOKENS for t in tokens):
        return ARTICLE
    return WORDED if inside == PLAIN and tokens & _ARTICLE_WORDS else inside


def tokens(html: str) -> Iterator[tuple[str, str, bool, str]]:
    """``(text, tag, is closing, attributes)``: the text before each tag, and last what follows them all (tag empty).

    Comments and declarations are left out.  Time is linear: every search
    either moves on or finds that what it looks for does not come any more.
    A ``<`` that opens no tag is text; a tag with a quote that never ends
    ends at the next ``>``.
    """
    at, text, closed = 0, [], True        # ``closed``: whether a ``>`` may still come
    gone: set[str] = set()                # raw elements that are not closed any more
    while True:
        m = _MARKUP.search(html, at) if closed else None
        if m is None:
            text.append(html[at:])
            yield "".join(text), "", False, ""
            return
        begin = m.start()
        text.append(html[at:begin])
        if m.group().startswith("<!") or m.group() == "<?":
            comment = m.group() == "<!--"
            end = html.find("-->" if comment else ">", begin + 2)
            at = len(html) if end < 0 and comment else end + (3 if comment else 1)
            if end < 0 and not comment:
                closed, at = False, begin
            continue
        name = _NAME.match(html, begin)
        end = _REST.match(html, name.end()).end()
        if html[end:end + 1] != ">":
            end = html.find(">", end)
            if end < 0:
                closed, at = False, begin
                continue
        tag, closing, attributes = name.group(2).lower(), bool(name.group(1)), html[name.end():end]
        at = end + 1
        yield "".join(text), tag, closing, attributes
        text = []
        if tag in _SKIPPED and not closing and not attributes.endswith("/"):
            stop = None if tag in gone else re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if stop:
                at = stop.end()
            else:
                gone.add(tag)
                at = len(html) if tag in ("script", "style") else at


def blocks(html: str) -> list[tuple[str, int]]:
    """The text blocks of a page in order, each with its kind; markup, scripts and comments are gone.

    Character references are decoded, white space in a block is one space,
    empty blocks are left out.  Unclosed elements end where a container
    around them ends.  The text of an inline element that is furniture is a
    block of its own, behind the one it stands in.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    pieces: list[str] = []
    aside: list[str] = []                   # text of an inline element that is furniture
    inline: list[str] = []                  # that element, and those of its name inside
    inside = 0                              # the depth of the stack it stands at
    kind = PLAIN

    def flush():
        for parts, k in ((pieces, kind), (aside, FURNITURE)):
            text = " ".join(htmllib.unescape("".join(parts)).split()) if parts else ""
            parts.clear()
            if text:
                out.append((text, k))
    for text, tag, closing, attributes in tokens(html):
        if text:
            (aside if inline else pieces).append(text)
        if tag in _SKIPPED or not tag:
            if tag in _BLOCKS:
                flush()
            continue
        if tag not in _BLOCKS:
            if tag == "br":
                (aside if inline else pieces).append(" ")
            elif inline:
                if tag == inline[0] and not closing:
                    inline.append(tag)
                elif tag == inline[0]:
                    inline.pop()
                    if not inline:
                        pieces.append(" ")
                        aside.append(" ")
            elif attributes and not closing and tag not in _VOID and kind != FURNITURE and not attributes.endswith("/") \
                    and _kind_of(tag, attributes, kind) == FURNITURE:
                inline, inside = [tag], len(stack)
                pieces.append(" ")
            continue
        flush()
        while stack and (stack[-1][0] in _SHORT or not closing and tag in _ENDS.get(stack[-1][0], ())):
            kind = stack.pop()[1]
        if tag not in _CONTAINERS and not closing:
            # of the other blocks only furniture counts
            if attributes and kind != FURNITURE and _kind_of(tag, attributes, kind) == FURNITURE:
                stack.append((tag, kind))
                kind = FURNITURE
        elif closing:
            for i in range(len(stack) - 1, -1, -1):
                if tag not in _CONTAINERS and stack[i][0] in _CONTAINERS:
                    break
                if stack[i][0] == tag:
                    kind = stack[i][1]
                    del stack[i:]
                    break
        else:
            stack.append((tag, kind))
            kind = _kind_of(tag, attributes, kind)
        if inline and (len(stack) < inside or closing and tag in _SHORT):
            inline = []                     # never closed: it ends with the block around it
    flush()
    return out


def common_lines(a: list[int], b: list[int]) -> list[bool]:
    """Which items of ``a`` are in a longest common subsequence with ``b`` (bit-parallel, one big integer a line)."""
    shared = set(a) & set(b)
    marks = [False] * len(a)
    rows_a = [i for i, x in enumerate(a) if x in shared]
    b = [x for x in b if x in shared]
    if not rows_a or not b:
        return marks
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v, rows = full, []
    for i in rows_a:
        rows.append(v)                  # zero bits of v: columns at which the length goes up
        u = v & places[a[i]]
        v = ((v + u) | (v - u)) & full
    rows.append(v)
    j = len(b)
    for k in range(len(rows_a) - 1, -1, -1):
        # the length of prefixes (k + 1, j) and (k, j)
        mask = (1 << j) - 1
        if (~rows[k + 1] & mask).bit_count() == (~rows[k] & mask).bit_count():
            continue
        marks[rows_a[k]] = True
        # its partner: the last column of this line at which the length goes up to the present one
        want = (~rows[k + 1] & mask).bit_count()
        p = j
        while (~rows[k + 1] & ((1 << (p - 1)) - 1)).bit_count() == want:
            p -= 1
        j = p - 1
    return marks


def _line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_URL = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"


def extract_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page row: page_id, url, text (blocks joined by a line feed), n_chars (code points).

    A null or empty html has the empty text.  A page without url, alone on
    its host, or with all its lines in its neighbours' (a copy) shows no
    difference: of such a page the marked article is the text, or, where
    nothing is marked, all but the furniture.  Rows with equal url are ordered
    by page_id.  Other columns are ignored; an empty table gives an empty result.
    """
    found = difference(pages, page_id=page_id, url=url, html=html)
    return found.select(page_id, url, "text", F.length("text").cast("long").alias("n_chars"))


def difference(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """:func:`extract_text` with how it came about: page_id, url, text, n_lines, n_shared, n_restored, n_removed.

    ``n_shared`` lines are deleted by the alignment with a neighbour,
    ``n_restored`` of them brought back because the page marks them as its
    article, and ``n_removed`` of those that the alignment left are taken out
    as furniture, or as unmarked lines of a page that shows no difference.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    source = pages.select(F.col(page_id).alias("page"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    source = source.withColumn("h", F.xxhash64("url", "html"))

    def lines_of(batches):
        for batch in batches:
            hashes, kinds = [], []      # a page without lines is nobody's neighbour
            for text in column(batch, "html").to_pylist():
                found = blocks(text or "")
                # lines of a WORDED element are only compared with their like
                hashes.append([_line_hash("\n" * (k == WORDED) + t) for t, k in found])
                kinds.append([k for _, k in found])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "page"), column(batch, "h"), column(batch, "host"), column(batch, "path"),
                 pa.array(hashes, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int32()))],
                names=["page", "h", "host", "path", "lines", "kinds"]).filter(pa.array([len(x) > 0 for x in hashes], pa.bool_()))
    located = source.where(F.col("url").isNotNull() & F.col("html").isNotNull()).select(
        "page", "h", F.lower(F.regexp_extract("url", _URL, 1)).alias("host"), F.regexp_extract("url", _URL, 2).alias("path"), "html")
    lines = located.mapInArrow(lines_of, f"page {kind}, h long, host string, path string, lines array<long>, kinds array<int>")
    placed = with_position(lines, "host", "path", "page", "h", name="html-lines")

    # the neighbours on either side, by position: no host is gathered anywhere
    near = placed.select(F.col("pos").alias("at"), F.col("host").alias("n_host"), F.col("lines").alias("n_lines"))
    both = placed.withColumn("at", F.explode(F.array(F.col("pos") - 1, F.col("pos") + 1))).join(near, "at").where(F.col("host") == F.col("n_host"))

    def compare(batches):
        for batch in batches:
            out = []
            for own, theirs, kinds in zip(*(column(batch, c).to_pylist() for c in ("lines", "n_lines", "kinds")), strict=True):
                marks = common_lines(own, theirs)
                copy = all(m for k, m in zip(kinds, marks, strict=True) if k != FURNITURE)
                out.append(None if copy else [i for i, m in enumerate(marks) if m])      # a copy shows no difference
            yield pa.RecordBatch.from_arrays(
                [column(batch, "page"), column(batch, "h"), pa.array(out, pa.list_(pa.int32()))], names=["page", "h", "gone"])
    compared = both.select("page", "h", "lines", "n_lines", "kinds").mapInArrow(compare, f"page {kind}, h long, gone array<int>")
    chosen = compared.where("gone is not null").groupBy("page", "h").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    chosen = materialize(chosen.select(F.col("page").alias("g_page"), F.col("h").alias("g_h"), "gone"), "html-gone")
    few = bounded(chosen)
    joined = source.join(few, (source["h"] == few["g_h"]) & source["page"].eqNullSafe(few["g_page"]), "left")

    def text_of(batches):
        for batch in batches:
            texts, counts = [], []
            for html_, gone in zip(column(batch, "html").to_pylist(), column(batch, "gone").to_pylist(), strict=True):
                found = blocks(html_ or "")
                marked = any(k == ARTICLE for _, k in found)
                shared = set(gone or ())
                left, restored, removed = [], 0, 0
                for i, (t, k) in enumerate(found):
                    own = k in (ARTICLE, WORDED)
                    # where no difference could be taken, markup alone decides
                    stays = own or (k == PLAIN and i not in shared and (gone is not None or not marked))
                    if stays:
                        left.append(t)
                    restored += own and i in shared
                    removed += not stays and i not in shared
                texts.append("\n".join(left))
                counts.append((len(found), len(shared), restored, removed))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "page"), column(batch, "url"), pa.array(texts, pa.string()),
                 *[pa.array([c[i] for c in counts], pa.int32()) for i in range(4)]],
                names=["page", "url", "text", "n_lines", "n_shared", "n_restored", "n_removed"])
    out = joined.select("page", "url", "html", "gone").mapInArrow(
        text_of, f"page {kind}, url string, text string, n_lines int, n_shared int, n_restored int, n_removed int")
    return out.select(F.col("page").alias(page_id), F.col("url").alias(url), "text", "n_lines", "n_shared", "n_restored", "n_removed")

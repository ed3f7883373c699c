"""Link catalogue over a table of HTML pages, entirely in JVM regex functions.

Per page: drop comments, scripts and styles (their text is not markup), take
the ``href`` of every ``<a>`` tag in document order (quoted values may hold any
character), unquote, decode character references, strip white space.  Then match a URL pattern, keep the first occurrence of
each URL (first page, first position), and type the captured groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns

# Markup patterns, entity table and the trip-file link format.
COMMENT_RE = r"(?s)<!--.*?-->"
SCRIPT_RE = r"(?is)<script\b.*?</script\s*>"
STYLE_RE = r"(?is)<style\b.*?</style\s*>"
# a whole tag, stepping over quoted values; possessive, so it never backtracks
ANCHOR_RE = r"""(?i)<a\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# the value of the first href attribute, going attribute by attribute
HREF_RE = (r"""(?i)^<a(?:[\s/]++(?!href[\s=>])[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
           r"""[\s/]++href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""")
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0")]
NUMERIC_ENTITY_RE = r"(?i)&#(x[0-9a-f]{1,6}|[0-9]{1,7});"
TRIP_LINK_RE = (r"(?i)^(https?://[^/]+/trip-data/(yellow|green|fhv|fhvhv)_tripdata_"
                r"(\d{4})-(\d{2})\.parquet)$")
TRIP_LINK_FIELDS = {"taxi_type": (2, "lower"), "year": (3, "int"), "month": (4, "int")}
SUPPORTED_TAXI_TYPES = ("yellow", "green", "fhv", "fhvhv")
TRIP_LINK_SCHEMA = "taxi_type string, year int, month int, url string"


def _decode(c: Column) -> Column:
    """Character references: the basic named ones, every numeric one, ``&amp;`` last."""
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))

    def one(text, ref):
        body = F.lower(F.regexp_extract(ref, NUMERIC_ENTITY_RE, 1))
        code = F.when(body.startswith("x"), F.conv(F.substring(body, 2, 6), 16, 10)).otherwise(body).cast("int")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
        return F.replace(text, ref, char)
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(NUMERIC_ENTITY_RE), 0))
    c = F.when(c.contains("&#"), F.aggregate(refs, c, one)).otherwise(c)
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def anchor_hrefs(pages: DataFrame, *, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """``(page_id, pos, href)``: every anchor href, 0-based position per page."""
    require_columns(pages, (html, page_id), "page table")
    if not isinstance(pages.schema[html].dataType, T.StringType):
        raise ValueError(f"column {html!r} must be text")
    body = F.col(html)
    for pat in (COMMENT_RE, SCRIPT_RE, STYLE_RE):
        body = F.regexp_replace(body, pat, "")
    hrefs = F.transform(F.regexp_extract_all(body, F.lit(ANCHOR_RE), 0), lambda tag: F.regexp_extract(tag, HREF_RE, 1))
    raw = F.filter(hrefs, lambda h: h != "")
    exploded = pages.select(F.col(page_id).alias("page_id"), F.posexplode(raw).alias("pos", "raw"))
    decoded = _decode(F.regexp_replace(F.col("raw"), r"""^["']|["']$""", ""))
    return exploded.select("page_id", "pos", F.regexp_replace(decoded, r"(?U)^\s+|\s+$", "").alias("href")) \
                   .where(F.length("href") > 0)


def first_occurrence(links: DataFrame, key: str = "url") -> DataFrame:
    """One row per ``key``: the row of the smallest ``(page_id, pos)``.

    A min over a struct is partially aggregated, so a URL repeated on a third
    of all pages is combined map-side before the shuffle.
    """
    others = [c for c in links.columns if c not in (key, "page_id", "pos")]
    pick = F.min(F.struct("page_id", "pos", *others)).alias("_f")
    return links.groupBy(key).agg(pick).select(key, "_f.*")


def extract_links(pages: DataFrame, pattern: str = TRIP_LINK_RE, fields=None, *,
                  url_group: int = 0, dedupe: bool = True, html: str = "html",
                  page_id: str = "page_id") -> DataFrame:
    """Matching links with typed fields, ``url``, and their ``page_id``, ``pos``.

    ``fields`` maps an output name to ``(group, kind)`` with kind ``"str"``,
    ``"lower"`` or ``"int"``; ``url`` is group ``url_group`` (0 = whole href).
    """
    fields = TRIP_LINK_FIELDS if fields is None and pattern == TRIP_LINK_RE else (fields or {})
    hrefs = anchor_hrefs(pages, html=html, page_id=page_id).where(F.col("href").rlike(pattern))
    typed = []
    for name, (group, kind) in fields.items():
        g = F.regexp_extract("href", pattern, group)
        typed.append((F.lower(g) if kind == "lower" else g.cast("int") if kind == "int" else g).alias(name))
    out = hrefs.select(*typed, F.regexp_extract("href", pattern, url_group).alias("url"), "page_id", "pos")
    return first_occurrence(out) if dedupe else out


def extract_trip_data_links(pages: DataFrame, **kw) -> DataFrame:
    """``taxi_type, year, month, url`` (+ ``page_id, pos``) of trip parquet links."""
    return extract_links(pages, TRIP_LINK_RE, TRIP_LINK_FIELDS, **kw) \
        .select("taxi_type", "year", "month", "url", "page_id", "pos")


def sort_links(links: DataFrame, keys=("taxi_type", "year", "month")) -> DataFrame:
    """Sink-side order; ties keep document order (page, position)."""
    return links.orderBy(*keys, "page_id", "pos")


def filter_links(links: DataFrame, *, taxi_types=None, year=None, months=None) -> DataFrame:
    """AND-combined optional filters, validated before any job runs."""
    cond = F.lit(True)
    if taxi_types is not None:
        if isinstance(taxi_types, str):
            taxi_types = [taxi_types]
        wanted = {str(t).lower() for t in taxi_types}
        unknown = wanted - set(SUPPORTED_TAXI_TYPES)
        if unknown:
            raise ValueError(f"no such taxi type: {', '.join(sorted(unknown))}; there are {', '.join(SUPPORTED_TAXI_TYPES)}")
        cond = cond & F.col("taxi_type").isin(sorted(wanted))
    if year is not None:
        cond = cond & (F.col("year") == int(year))
    if months is not None:
        ms = list(months)
        for m in ms:
            if isinstance(m, bool) or not isinstance(m, int) or not 1 <= m <= 12:
                raise ValueError(f"a month is a whole number from 1 to 12, not {m!r}")
        cond = cond & F.col("month").isin(ms)
    return links.where(cond)


def filter_values(links: DataFrame, column: str, values, *, case_insensitive: bool = True) -> DataFrame:
    """Generic membership filter on one catalogue column."""
    vals = [str(v).lower() for v in values] if case_insensitive else list(values)
    c = F.lower(F.col(column)) if case_insensitive else F.col(column)
    return links.where(c.isin(vals))

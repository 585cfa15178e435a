"""Anchor-level extraction for both publishers (F6..F11, W3, W4, X14..X16).

``anchors`` is the native path: when only links are needed, one
``regexp_extract_all`` pass over the HTML finds every ``<a href>`` and short
patterns on each match give its link and inner text, without leaving the JVM.  Table-structured fields (sibling rows,
label/value cells) need the DOM facts of ``bidlake.operators.html``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.functions import urls as U
from bidlake.operators import dedup, filters

# --- fixed values -----------------------------------------------------------
# href in double quotes, in single quotes or bare; then the inner HTML.
ANCHOR_PATTERN = r"""(?is)<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
TAG_PATTERN = r"<[^>]*>"
# Character references decoded in anchor text (``&amp;`` last).
ENTITIES: tuple[tuple[str, str], ...] = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"),
)
# ---------------------------------------------------------------------------


def unescape(c: Column) -> Column:
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def anchor_text(inner: Column) -> Column:
    """Inner HTML of an anchor -> its visible text (tags become separators)."""
    return T.collapse_ws(unescape(F.regexp_replace(inner, TAG_PATTERN, " ")))


def anchors(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every anchor with an href: (id, link_pos, href, raw_text), document order."""
    whole = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(ANCHOR_PATTERN), 0)
    found = pages.select(F.col(id_col), F.posexplode(whole).alias("link_pos", "_a"))
    return found.select(
        F.col(id_col), F.col("link_pos").cast("bigint").alias("link_pos"),
        F.regexp_replace("_a", ANCHOR_PATTERN, "$1$2$3").alias("href"), anchor_text(F.regexp_replace("_a", ANCHOR_PATTERN, "$4")).alias("text"))


def devex_listings(links: DataFrame, min_len: int, alert: Column | None = None,
                   id_col: str = "page_id") -> DataFrame:
    """First publisher: decode tracker, deny-list, title rules, first per title."""
    decoded = links.withColumn("url", U.decode_tracking_url(T.trim_ws("href")))
    kept = decoded.where(filters.devex_link_ok("url"))
    titled = kept.withColumn("title", filters.link_title("text", filters.GENERIC_TITLES_DEVEX))
    ok = titled.where(filters.title_ok("title", min_len, alert))
    keyed = ok.withColumn("_tkey", F.lower(T.trim_ws("title")))
    return dedup.first_wins(keyed, [id_col, "_tkey"], "link_pos").drop("_tkey")


def da_listings(links: DataFrame, min_len: int, id_col: str = "page_id") -> DataFrame:
    """Second publisher: deny/allow lists, title length, first per cleaned URL."""
    href = T.trim_ws("href")
    kept = links.withColumn("_href", href).where(filters.da_link_ok("_href"))
    titled = kept.withColumn("title", filters.link_title("text", filters.GENERIC_TITLES_DA))
    ok = titled.where((F.col("title") != "") & (F.length("title") >= min_len))
    cleaned = ok.withColumn("url", U.clean_url("_href"))
    return dedup.first_wins(cleaned, [id_col, "url"], "link_pos").drop("_href")

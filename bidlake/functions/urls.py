"""URL expressions: tracker decoding, tracking-parameter removal and the
publishers' link deny/allow lists, as native regex predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlake.functions.text import WORD, WS, col_

# --- fixed values -----------------------------------------------------------
# Redirect host wrapping the first publisher's links; the target follows the
# second path segment.
TRACKER_PATTERN = r"(?i)track\.pstmrk\.it/[" + WORD + r"]+/([^?#" + WS + r"]+)"

# Links of the first publisher that are not listings (tested on the decoded URL).
DEVEX_SKIP_PATTERN = (
    r"(?i)devex\.com/(home|jobs|news|people|organizations|pro|user|account|unsubscribe|settings)"
    r"|devex\.zendesk"
    r"|linkedin\.com|twitter\.com|facebook\.com|instagram\.com|servedbyadbutler"
    r"|mailto:|#|javascript:"
    r"|devex\.com/?\?access_key"
    r"|funding/r\?access_key"
    r"|filter%5Btype%5D|filter\[type\]"
)

# Links of the second publisher that are not listings.
DA_SKIP_PATTERN = (
    r"(?i)(developmentaid\.(org|info)/(login|register|account|settings|unsubscribe|about|contact|home|news|blog|organizations)|"
    r"linkedin\.com|twitter\.com|facebook\.com|instagram\.com|"
    r"mailto:|#|javascript:|"
    r"developmentaid\.(org|info)/?$)"
)

# Listing links of the second publisher.
DA_LISTING_PATTERN = r"(?i)developmentaid\.(org|info)/(tenders|grants|funding|opportunities|contracts|jobs)/"

# Tracking parameters removed from listing URLs.
TRACKING_PARAM_PATTERN = r"[?&](utm_[^&]+|ref=[^&]+|source=[^&]+)"
# ---------------------------------------------------------------------------


def percent_decode(c: Column | str) -> Column:
    """Percent-decoding that keeps ``+`` literal; undecodable input is kept raw."""
    raw = col_(c)
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def decode_tracking_url(href: Column | str) -> Column:
    """Target of a tracker redirect (percent-decoded), else the href unchanged."""
    h = col_(href)
    target = F.regexp_extract(F.coalesce(h, F.lit("")), TRACKER_PATTERN, 1)
    return F.when(target != "", percent_decode(target)).otherwise(h)


def clean_url(url: Column | str) -> Column:
    """Drop utm_*/ref/source parameters, then trailing ``?``/``&``.

    Removing the first parameter can leave ``path&id=5``: kept as is.
    """
    dropped = F.regexp_replace(F.coalesce(col_(url), F.lit("")), TRACKING_PARAM_PATTERN, "")
    return F.regexp_replace(dropped, r"[?&]+\z", "")


def devex_skip(url: Column | str) -> Column:
    return F.coalesce(col_(url), F.lit("")).rlike(DEVEX_SKIP_PATTERN)


def da_skip(url: Column | str) -> Column:
    return F.coalesce(col_(url), F.lit("")).rlike(DA_SKIP_PATTERN)


def da_listing(url: Column | str) -> Column:
    return F.coalesce(col_(url), F.lit("")).rlike(DA_LISTING_PATTERN)

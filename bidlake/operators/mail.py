"""Feed B (alert e-mails) after extraction: enrichment (P3) and the
first-wins append against the opportunity table (W2, J2, A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.functions import dates as D
from bidlake.functions import normalize as N

# --- fixed values -----------------------------------------------------------
SOURCE_LABELS = {"devex": "Devex", "developmentaid": "DevelopmentAid"}
NEW_STATUS = "New"
# ---------------------------------------------------------------------------


def source_label(source_col: str = "mailSource"):
    """Publisher label; unknown sources produce no rows (filtered by caller)."""
    s = F.col(source_col)
    return F.when(s == "devex", F.lit(SOURCE_LABELS["devex"])).when(
        s == "developmentaid", F.lit(SOURCE_LABELS["developmentaid"]))


def enrich(opps: DataFrame, run_date: str, run_ts: str, lenient_dates: bool = True) -> DataFrame:
    """P3 + X7..X11: extracted opportunities -> the 20 table columns (+ ``ord``).

    Expected input columns: ord, mailSource, opportunityTitle, donorClient,
    countryRegion; optional: emailDate, emailSubject, alertName,
    opportunityType, status, deadline, deadlineISO, url.
    """
    def opt(c: str):
        return F.coalesce(F.col(c), F.lit("")) if c in opps.columns else F.lit("")

    known = opps.where(F.col("mailSource").isin(*SOURCE_LABELS))
    label = source_label()
    title = opt("opportunityTitle")
    return known.select(
        F.col("ord"),
        label.alias("source"),
        opt("emailDate").alias("emailDate"),
        opt("emailSubject").alias("emailSubject"),
        opt("alertName").alias("alertName"),
        title.alias("opportunityTitle"),
        opt("donorClient").alias("donorClient"),
        opt("countryRegion").alias("countryRegion"),
        opt("opportunityType").alias("opportunityType"),
        opt("status").alias("status"),
        opt("deadline").alias("deadline"),
        (D.deadline_fallback(opt("deadlineISO"), opt("deadline"), run_date, lenient_dates)
         if "deadline" in opps.columns else opt("deadlineISO")).alias("deadlineISO"),
        opt("url").alias("url"),
        N.infer_language(title).alias("language"),
        F.lit("").alias("fitScore"),
        F.lit("").alias("fitLabel"),
        F.lit("").alias("reviewSummary"),
        N.duplicate_key(label, title, opt("donorClient"), opt("countryRegion"), opt("url")).alias("duplicateKey"),
        F.lit(run_ts).alias("processedAtUTC"),
        F.lit("").alias("owner"),
        F.lit(NEW_STATUS).alias("pipelineStatus"),
    )


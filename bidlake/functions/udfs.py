"""The only Python functions of the engine, both Arrow-batched Pandas UDFs.

They hold the one thing Spark has no built-in for: Unicode NFKD
decomposition.  Callers pass NULL for rows that do not need the helper (a UDF
under ``when`` still runs for every row), so the Python side only sees the
residue.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


_NON_WORD_RUN = re.compile(r"[^\w]+")


def _normal_form(v: str) -> str:
    return _NON_WORD_RUN.sub(" ", unicodedata.normalize("NFKD", v).lower()).strip(" ")


@F.pandas_udf(StringType())
def nfkd_normal_form(values: pd.Series) -> pd.Series:
    """NFKD, lower-case, every run of non-word characters to one space, trimmed.

    (Replacing punctuation by spaces and then collapsing whitespace is the
    same as collapsing each run of non-word characters, whitespace included.)
    """
    return values.map(lambda v: _normal_form(v) if isinstance(v, str) else None)


PART = "\x1f"  # between the parts of a key; inside a part it counts as any other sign


@F.pandas_udf(StringType())
def nfkd_normal_forms(values: pd.Series) -> pd.Series:
    """The normal form of each ``PART``-separated part, in the same layout."""
    return values.map(lambda v: PART.join(map(_normal_form, v.split(PART))) if isinstance(v, str) else None)

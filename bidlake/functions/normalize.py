"""Text normal form, language flag, stable listing id and duplicate key.

``normalize_text`` = NFKD -> lower -> non-word to space -> collapse -> strip.
Spark has no NFKD, so only rows holding a non-ASCII character are sent
(Arrow-batched) to the ``nfkd_normal_form`` helper; ASCII rows never leave the JVM.
The character class is spelled ``[^\\p{L}\\p{N}_<ws>]`` on purpose: Java's
``(?U)\\w`` keeps combining marks while Python's ``\\w`` does not, so an
accented letter must become ``base + ' '`` (``Consultoría`` ->
``consultori a``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlake.functions.text import WORD, col_
from bidlake.functions.udfs import PART, nfkd_normal_form, nfkd_normal_forms

# --- fixed values -----------------------------------------------------------
# Words marking a Spanish title (matched case-insensitively as whole words).
SPANISH_MARKERS: tuple[str, ...] = (
    "de", "para", "en", "del", "los", "las", "con", "por", "una", "hacia",
    "servicios", "proyecto", "consultoría", "consultoria", "evaluación",
    "evaluacion", "fortalecimiento", "implementación", "implementacion",
    "asistencia técnica", "asistencia tecnica",
)
# Query parameter carrying a listing's stable report id, and the key prefix.
STABLE_ID_PARAM = "report"
STABLE_ID_PREFIX = "devex-report:"
KEY_SEPARATOR = " | "
# ---------------------------------------------------------------------------

SPANISH_PATTERN = "(?iu)(^|[^" + WORD + "])(" + "|".join(SPANISH_MARKERS) + ")([^" + WORD + "]|$)"


def is_ascii(c: Column | str) -> Column:
    """True when every character is 7-bit (bytes == characters)."""
    return F.octet_length(col_(c)) == F.length(col_(c))


def normalize_text(c: Column | str) -> Column:
    """NFKD, lower-case, punctuation to space, whitespace collapsed; NULL -> ''.

    Punctuation-to-space followed by whitespace collapsing equals replacing
    every run of non-word characters (whitespace included) by one space, so
    one regex pass suffices.  ASCII rows stay in the JVM (NFKD is the
    identity there, and the word class is ``[a-z0-9_]`` after lower-casing);
    the rest go once, whole, to the Arrow helper.
    """
    s = F.coalesce(col_(c), F.lit(""))
    ascii_row = is_ascii(s)
    jvm = F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9_]+", " "))
    # The helper receives NULL for ASCII rows, so it only works on the others.
    python = nfkd_normal_form(F.when(~ascii_row, s))
    return F.when(ascii_row, jvm).otherwise(python)


def infer_language(title: Column | str) -> Column:
    """``Spanish`` if a marker word occurs, else ``English``; NULL/'' -> ''."""
    t = F.coalesce(col_(title), F.lit(""))
    return F.when(t == "", F.lit("")).when(t.rlike(SPANISH_PATTERN), F.lit("Spanish")).otherwise(F.lit("English"))


def stable_id(url: Column | str) -> Column:
    """``devex-report:<id>`` from a ``report=`` query parameter, else ''."""
    found = F.regexp_extract(F.coalesce(col_(url), F.lit("")), f"[?&]{STABLE_ID_PARAM}=([{WORD}-]+)", 1)
    return F.when(found != "", F.concat(F.lit(STABLE_ID_PREFIX), found)).otherwise(F.lit(""))


def duplicate_key(source: Column | str, title: Column | str, donor: Column | str,
                  country: Column | str, url: Column | str | None = None) -> Column:
    """Stable id when the URL carries one, else four normalised parts.

    The fallback always has three separators: blanks stay as empty parts.
    """
    parts = [F.replace(F.coalesce(col_(c), F.lit("")), F.lit(PART), F.lit(" ")) for c in (source, title, donor, country)]
    joined = F.concat_ws(PART, *parts)
    ascii_row = is_ascii(joined)
    # one pass over all parts; the helper sees the rows that are not ASCII, once
    jvm = F.regexp_replace(F.lower(joined), f"[^a-z0-9_{PART}]+", " ")
    forms = F.transform(F.split(F.when(ascii_row, jvm).otherwise(nfkd_normal_forms(F.when(~ascii_row, joined))), PART), lambda part: F.trim(part))
    whole = F.array_join(forms, KEY_SEPARATOR)
    if url is None:
        return whole
    sid = stable_id(url)
    return F.when(sid != "", F.concat(F.element_at(forms, 1), F.lit(KEY_SEPARATOR), sid)).otherwise(whole)

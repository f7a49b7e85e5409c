"""String functions on names and headers.

Column functions return ``Column`` expressions built only from Spark
built-ins, so they stay inside whole-stage code generation.  Header
functions are plain Python: they run on the driver over column *names*
(schema metadata), never over data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent folding applied to upper-case candidate names before
# keyword matching (source characters and their replacements, pairwise).
ACCENTED_UPPER = "ÉÈÊÀÂÇÔÙÛ"
FOLDED_UPPER = "EEEAACOUU"
# The one alias rewrite applied after hyphen removal.
NAME_ALIASES = {"DUPONT AIGNAN": "DUPONTAIGNAN"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Whitespace removed at both ends of names, like Python's ``str.strip()``
# (ASCII whitespace plus the no-break spaces common in spreadsheet exports).
STRIP_CHARS = " \t\n\x0b\x0c\r\xa0\u2007\u202f"
_STRIP_RE = "^[\\s\u00a0\u2007\u202f]+|[\\s\u00a0\u2007\u202f]+$"


def strip_blanks(c) -> Column:
    """Remove leading and trailing whitespace, no-break spaces included."""
    return F.regexp_replace(_c(c), _STRIP_RE, "")


def fold_accents(c) -> Column:
    """Upper-case accent folding (X2): É È Ê → E, À Â → A, Ç → C, Ô → O, Ù Û → U."""
    return F.translate(_c(c), ACCENTED_UPPER, FOLDED_UPPER)


def normalise_name(c, null_as_empty: bool = True) -> Column:
    """Trim, upper, fold accents, hyphen → blank, one pass of
    double blank → single blank, then the fixed alias rewrites.

    A null name becomes ``''`` (not the text ``'nan'``) when
    ``null_as_empty`` is set.
    """
    s = _c(c).cast("string")
    if null_as_empty:
        s = F.coalesce(s, F.lit(""))
    s = fold_accents(F.upper(strip_blanks(s)))
    s = F.replace(s, F.lit("-"), F.lit(" "))
    s = F.replace(s, F.lit("  "), F.lit(" "))
    for old, new in NAME_ALIASES.items():
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def lookup_key(c) -> Column:
    """Key used to look a candidate name up in a mapping table: trimmed,
    upper-case, accents folded (so ``MÉLENCHON`` finds ``MELENCHON``)."""
    return fold_accents(F.upper(strip_blanks(_c(c).cast("string"))))


def keyword_pattern(keywords: Iterable[str]) -> str:
    """Case-insensitive alternation of keywords (F7), each taken literally;
    accented letters fold too."""
    kws = [k for k in keywords if k]
    if not kws:
        return "(?!)"  # matches nothing
    return "(?iu)(" + "|".join(re.escape(k) if re.search(r"[\\.^$*+?{}\[\]|()]", k) else k
                              for k in kws) + ")"


def contains_any(c, keywords: Iterable[str]) -> Column:
    """case-insensitive substring match against any keyword; null → false."""
    return F.coalesce(_c(c).rlike(keyword_pattern(keywords)), F.lit(False))


def year_quarter(label) -> tuple[Column, Column]:
    """Parse a quarter label into (year, quarter).

    Both spellings are accepted: ``2002-T1`` and ``T1_2002`` (the shipped
    unemployment file uses the latter).  Anything else gives nulls.
    """
    s = _c(label)
    y1 = F.regexp_extract(s, r"^(\d{4})-T(\d)$", 1)
    q1 = F.regexp_extract(s, r"^(\d{4})-T(\d)$", 2)
    q2 = F.regexp_extract(s, r"^T(\d)_(\d{4})$", 1)
    y2 = F.regexp_extract(s, r"^T(\d)_(\d{4})$", 2)
    year = F.when(y1 != "", y1).when(y2 != "", y2).cast("int")
    quarter = F.when(q1 != "", q1).when(q2 != "", q2).cast("int")
    return year, quarter


# --------------------------------------------------------------------------
# Header (column-name) normalisers: driver-side, over schema metadata only.
# --------------------------------------------------------------------------

# Lower-case accent replacements used by the full header
# normaliser (P1), applied in this order.
HEADER_ACCENTS = [("é", "e"), ("è", "e"), ("ê", "e"), ("à", "a"), ("ç", "c")]


def normalise_header(name: str) -> str:
    """Lower, no-break space → blank, ``-`` and blank → ``_``, accents,
    then strip.  Strip runs last, so outer blanks have already become ``_``."""
    s = name.lower().replace("\xa0", " ").replace("-", "_").replace(" ", "_")
    for a, b in HEADER_ACCENTS:
        s = s.replace(a, b)
    return s.strip()


def light_header(name: str) -> str:
    """No-break space → blank, strip."""
    return name.replace("\xa0", " ").strip()


def unquote_header(name: str) -> str:
    """Remove double quotes, strip."""
    return name.replace('"', "").strip()

"""Projection and schema harmonisation (P1-P14, C5 over many columns).

These operators rewrite column *names* (driver-side over the schema) and
then issue one ``select``/``toDF`` so the whole harmonisation is a single
projection in the plan: no extra scan, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.functions.numbers import decimal_comma
from civica.functions.text import light_header, normalise_header, unquote_header


def rename_headers(df: DataFrame, fn: Callable[[str], str] = normalise_header) -> DataFrame:
    """Apply a header normaliser to every column name (``toDF``)."""
    return df.toDF(*[fn(c) for c in df.columns])


def normalise_headers(df: DataFrame) -> DataFrame:
    return rename_headers(df, normalise_header)


def light_headers(df: DataFrame) -> DataFrame:
    return rename_headers(df, light_header)


def unquote_headers(df: DataFrame) -> DataFrame:
    return rename_headers(df, unquote_header)


def rename_aliases(df: DataFrame, mapping: Mapping[str, str], on_collision: str = "error") -> DataFrame:
    """Rename header variants to canonical names; absent names are
    ignored.  Two columns ending with one name is an error
    (``on_collision='error'``) or resolved by keeping the last one
    (``'keep_last'``, P10)."""
    new = [mapping.get(c, c) for c in df.columns]
    if len(set(new)) != len(new):
        if on_collision == "error":
            dup = sorted({n for n in new if new.count(n) > 1})
            raise ValueError(f"rename makes duplicate columns: {dup}")
        return dedupe_keep_last(df.toDF(*new))
    return df.toDF(*new)


def resolve_key(df: DataFrame, candidates: Iterable[str], target: str) -> DataFrame:
    """P5: rename the first present candidate to ``target``; error if none."""
    for c in candidates:
        if c in df.columns:
            return df if c == target else df.withColumnRenamed(c, target)
    raise ValueError(f"'{target}' not found; columns: {df.columns}")


def dedupe_keep_last(df: DataFrame) -> DataFrame:
    """P10: of duplicated column names keep the last occurrence (positional)."""
    names = df.columns
    tmp = [f"__c{i}" for i in range(len(names))]
    keep = [i for i, n in enumerate(names) if n not in names[i + 1:]]
    return df.toDF(*tmp).select(*[F.col(tmp[i]).alias(names[i]) for i in keep])


UNNAMED = re.compile(r"^(Unnamed|_c\d+$)")


def drop_unnamed(df: DataFrame, pattern: re.Pattern = UNNAMED) -> DataFrame:
    """Drop columns whose header is blank (pandas ``Unnamed: n``,
    Spark ``_cN``)."""
    return df.drop(*[c for c in df.columns if pattern.search(c)])


def block_rename_map(blocks: int, fields: Mapping[str, str], first_suffix: str = "",
                     suffix: Callable[[int], str] = lambda i: f".{i}",
                     target: Callable[[str, int], str] = lambda f, i: f if i == 1 else f"{f}_{i}") -> dict:
    """Generate the rename map for ``blocks`` repeated candidate
    blocks, e.g. ``Nom.2 → nom_2``.  ``fields`` maps source stem → target stem."""
    out = {}
    for i in range(1, blocks + 1):
        sfx = first_suffix if i == 1 else suffix(i)
        for src, dst in fields.items():
            out[f"{src}{sfx}"] = target(dst, i)
    return out


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def complement(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """All columns except the given ones, in schema order."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def columns_with_prefix(df: DataFrame, prefix: str, exclude_prefix: str | None = None) -> list[str]:
    """Columns starting with a prefix (``Nom.``, ``Voix.``), optionally
    excluding another prefix (``% Voix``)."""
    return [c for c in df.columns
            if c.startswith(prefix) and not (exclude_prefix and c.startswith(exclude_prefix))]


def parse_decimal_columns(df: DataFrame, words: Iterable[str] = ("pourcentage", "taux")) -> DataFrame:
    """C5 over all string columns whose name holds one of the words."""
    words = tuple(words)
    todo = {f.name: decimal_comma(F.col(f"`{f.name}`")) for f in df.schema.fields
            if any(w in f.name for w in words) and f.dataType.typeName() == "string"}
    return df.withColumns(todo) if todo else df


# Headers of a year's candidate rows and their standard names
# (P8), and the columns that the share analysis cannot do without.
YEAR_HEADERS = {
    2017: {"Sexe": "sexe", "Nom": "nom", "Prénom": "prenom", "Voix": "voix", "% Voix/Exp": "pourcentage_voix_exprimes"},
    2022: {"Nom": "nom", "% Voix/Exp": "pourcentage_voix_exprimes"},
}
YEAR_REQUIRED = ("nom", "pourcentage_voix_exprimes")


def standardise_year(df: DataFrame, year: int, headers: Mapping[int, Mapping[str, str]] = YEAR_HEADERS,
                     required: Iterable[str] = YEAR_REQUIRED) -> tuple[DataFrame, list[str]]:
    """A year's headers under their standard names (of columns that then
    share a name the last stays, P10), and the required columns that are
    missing.  A year without a map keeps its headers."""
    out = rename_aliases(df, headers.get(year, {}), on_collision="keep_last")
    return out, require_columns(out, required)


def require_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Q3: the required columns that are missing (driver-side schema diff)."""
    return [c for c in required if c not in df.columns]


# Canonical names of header variants (P4), as found in yearly
# result files after header normalisation.
HEADER_ALIASES = {
    "code_du_departement": "code_region",
    "code_departement": "code_region",
    "code_de_la_commune": "code_commune",
    "code_du_canton": "code_canton",
    "code_de_la_region": "code_region",
    "code_du_b_vote": "code_b_vote",
    "libelle_du_departement": "nom_departement",
    "libelle_departement": "nom_departement",
    "libelle_du_canton": "nom_canton",
    "libelle_de_la_commune": "nom_commune",
    "pourcentage_abstention_inscrit": "pourcentage_abstentions_inscrits",
    "pourcentage_abstention_inscrits": "pourcentage_abstentions_inscrits",
    "pourcentage_votant_inscrit": "pourcentage_votants_inscrits",
    "pourcentage_blanc_nuls_inscrit": "pourcentage_blancs_nuls_inscrits",
    "pourcentage_blanc_nuls_votant": "pourcentage_blancs_nuls_votants",
    "pourcentage_blanc_nuls_inscrits": "pourcentage_blancs_nuls_inscrits",
    "pourcentage_blanc_nuls_votants": "pourcentage_blancs_nuls_votants",
    "%_blnuls_ins": "pourcentage_blancs_nuls_inscrits",
    "%_blnuls_vot": "pourcentage_blancs_nuls_votants",
    "%_exp_ins": "pourcentage_exprimes_inscrits",
    "%_exp_vot": "pourcentage_exprimes_votants",
    "%_nuls_ins": "pourcentage_nuls_inscrits",
    "%_nuls_vot": "pourcentage_nuls_votants",
    "%_blancs_ins": "pourcentage_blancs_inscrits",
    "%_blancs_vot": "pourcentage_blancs_votants",
    "%_abs_ins": "pourcentage_abstentions_inscrits",
    "%_vot_ins": "pourcentage_votants_inscrits",
}
# Candidate names of the region key, first present wins (P5).
REGION_KEY_CANDIDATES = ["code_region", "code_du_departement", "code_departement"]


def harmonise(df: DataFrame) -> DataFrame:
    """P9 → P1 → P4 (+P10 on collisions) → P5: the header pipeline of a
    yearly results file, as one projection."""
    df = normalise_headers(drop_unnamed(df))
    df = rename_aliases(df, HEADER_ALIASES, on_collision="keep_last")
    return resolve_key(df, REGION_KEY_CANDIDATES, "code_region")

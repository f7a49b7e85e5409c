"""Wide ↔ long reshaping.

Wide → long is one generator (``inline`` over an ``array<struct>``) in a
single projection: one scan of the wide table, no union of N copies.
Long → wide is ``groupBy().pivot(values)``; the value list is always passed
so Spark does not run an extra job to discover it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civica.functions.text import year_quarter
from civica.session import cut_lineage


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _suffix_default(i: int) -> str:
    return "" if i == 1 else f"_{i}"


def suffix_blocks(columns: Sequence[str], fields: Sequence[str],
                  suffix: Callable[[int], str] = _suffix_default) -> list[int]:
    """Block numbers whose first field is present in the schema.  No block
    number exceeds the largest number in a name that begins with the field."""
    own = [c[len(fields[0]):] for c in columns if c.startswith(fields[0])]
    last = max((int(n) for tail in own for n in re.findall(r"[0-9]+", tail)), default=1)
    present = set(columns)
    return [i for i in range(1, last + 1) if f"{fields[0]}{suffix(i)}" in present]


def _inline(df: DataFrame, ids: Sequence[str], structs: list[Column], index_col: str | None) -> DataFrame:
    arr = F.array(*structs)
    if index_col:
        return df.select(*[_q(c) for c in ids], F.posexplode(arr).alias(index_col, "__blk")) \
                 .select(*[_q(c) for c in ids], index_col, "__blk.*") \
                 .withColumn(index_col, F.col(index_col) + 1)
    return df.select(*[_q(c) for c in ids], F.inline(arr))


def long_by_suffix(df: DataFrame, ids: Sequence[str], fields: Sequence[str],
                   suffix: Callable[[int], str] = _suffix_default,
                   required: Sequence[str] | None = None, index_col: str | None = None) -> DataFrame:
    """``nom, nom_2 … nom_16`` (and siblings) → one row per block.
    Rows with a null in ``required`` (default: first and last field) are
    dropped.  A field missing from the schema for some block reads as null."""
    blocks = suffix_blocks(df.columns, fields, suffix)
    if not blocks:
        raise ValueError(f"no block of {fields[0]!r} found")
    types = {f.name: f.dataType for f in df.schema.fields}
    # A field's type comes from the first block that has it, so a field
    # missing from some blocks (even the first) still reads as a typed null.
    ftype = {f: next((types[f"{f}{suffix(i)}"] for i in blocks if f"{f}{suffix(i)}" in types), None)
             for f in fields}
    structs = []
    for i in blocks:
        parts = []
        for f in fields:
            name = f"{f}{suffix(i)}"
            c = _q(name) if name in df.columns else F.lit(None)
            if ftype[f] is not None:
                c = c.cast(ftype[f])
            parts.append(c.alias(f))
        structs.append(F.struct(*parts))
    out = _inline(df, ids, structs, index_col)
    req = list(required) if required is not None else [fields[0], fields[-1]]
    return out.na.drop(how="any", subset=req) if req else out


def long_by_block(df: DataFrame, n_common: int, block_fields: Sequence[str],
                  keep_if_present: Sequence[int] = (0, 1), index_col: str | None = None,
                  common_names: Sequence[str] | None = None) -> DataFrame:
    """R2: wide → long by *position*: the first ``n_common`` columns are
    kept on every row, the rest is cut into blocks of ``len(block_fields)``.
    An incomplete trailing block is ignored; a block is kept on a row only if
    the fields at ``keep_if_present`` are non-null."""
    cols = df.columns
    k = len(block_fields)
    n_blocks = (len(cols) - n_common) // k
    tmp = [f"__p{i}" for i in range(len(cols))]
    d = df.toDF(*tmp)
    ids = common_names or cols[:n_common]
    structs = [F.struct(*[F.col(tmp[n_common + b * k + j]).alias(block_fields[j]) for j in range(k)])
               for b in range(n_blocks)]
    d = d.select(*[F.col(tmp[i]).alias(ids[i]) for i in range(n_common)], *tmp[n_common:n_common + n_blocks * k])
    out = _inline(d, ids, structs, index_col)
    return out.na.drop(how="any", subset=[block_fields[i] for i in keep_if_present])


def long_by_detect(df: DataFrame, fields: Sequence[str], ids: Sequence[str] | None = None,
                   sep: str = ".", index_col: str = "candidate_number",
                   rename: dict | None = None, drop: Sequence[str] = ("N°Panneau",)) -> DataFrame:
    """Detect numbered blocks ``Nom.1 … Nom.n`` for every field.  If the
    fields do not have the same number of blocks the input is inconsistent
    and the result is empty (with the expected schema).  ``index_col`` is
    the 1-based position of the block; rows without a first field (name)
    are dropped, as are the block columns from the id part and the numbered
    columns of the fields in ``drop`` (panel numbers)."""
    pat = {f: re.compile("^" + re.escape(f + sep) + r"(\d+)$") for f in fields}
    found = {f: [c for c in df.columns if pat[f].match(c)] for f in fields}
    block_cols = {c for cols in found.values() for c in cols}
    block_cols |= {c for c in df.columns for f in drop if re.fullmatch(re.escape(f + sep) + r"\d+", c)}
    keep = [c for c in (ids or df.columns) if c not in block_cols]
    rename = rename or {}
    n = len(found[fields[0]])
    if n == 0 or any(len(v) != n for v in found.values()):
        types = {f.name: f.dataType for f in df.schema.fields}
        typed = [F.lit(None).cast(types[found[f][0]] if found[f] else "string").alias(rename.get(f, f)) for f in fields]
        return df.select(*[_q(c) for c in keep], F.lit(None).cast("int").alias(index_col), *typed).limit(0)
    structs = [F.struct(*[_q(found[f][i]).alias(rename.get(f, f)) for f in fields]) for i in range(n)]
    out = df.select(*[_q(c) for c in keep], F.posexplode(F.array(*structs)).alias("__pos", "__blk"))
    out = out.select(*[_q(c) for c in keep], (F.col("__pos") + 1).alias(index_col), "__blk.*")
    return out.where(F.col(f"`{rename.get(fields[0], fields[0])}`").isNotNull())


def unpivot(df: DataFrame, value_columns: Sequence[str], ids: Sequence[str] = (),
            name_col: str = "label", value_col: str = "value") -> DataFrame:
    """Wide → (label, value) over the given columns (``pd.melt``)."""
    return df.unpivot(list(ids), list(value_columns), name_col, value_col)


def unpivot_quarters(df: DataFrame, value_columns: Sequence[str], ids: Sequence[str] = (),
                     value_col: str = "value", drop_null: bool = True) -> DataFrame:
    """R4+R5: quarter columns → (annee, trimestre, value).  Labels may be
    ``2002-T1`` or ``T1_2002``; columns with other names are not passed."""
    long = unpivot(df, value_columns, ids, "__label", value_col)
    y, q = year_quarter("__label")
    out = long.select(*ids, y.alias("annee"), q.alias("trimestre"), F.col(value_col).try_cast("double").alias(value_col))
    return out.na.drop(subset=[value_col]) if drop_null else out


def pivot_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a pivot column, fetched with a proven bound:
    at most ``spark.sql.pivotMaxValues`` (Spark's own pivot limit) are read;
    more is an error, never a silent truncation."""
    cap = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    vals = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(cap + 1).collect()]
    if len(vals) > cap:
        raise ValueError(f"{column!r} has more than {cap} distinct values; not a pivot column")
    return sorted(vals)


def pivot_mean(df: DataFrame, index: Sequence[str], column: str, value: str,
               values: Sequence) -> DataFrame:
    """Mean of ``value`` per index row and pivot value."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.avg(value))


def pivot_sum(df: DataFrame, index: Sequence[str], column: str, value: str,
              values: Sequence) -> DataFrame:
    """Long table → matrix of sums."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.sum(value))


def unstack_zero_fill(df: DataFrame, index: Sequence[str], column: str, value: str,
                      values: Sequence[str]) -> DataFrame:
    """Group-sum then unstack.  A category absent from the whole table
    becomes a column of 0.0; one present in some index rows stays null in the
    others (fill of missing columns).

    The facts are read once: index rows and the values present come from the
    same grouped sums, written to the shared folder (one row per index row
    and category)."""
    sums = cut_lineage(df.groupBy(*index, column).agg(F.sum(value).alias("__sum")), name="unstack")
    present = sums.where(F.col(column).isin(list(values))).agg(F.collect_set(column)).scalar()
    wide = sums.groupBy(*index).agg(*[F.sum(F.when(F.col(column) == v, F.col("__sum"))).alias(f"__v{i}")
                                      for i, v in enumerate(values)])
    return wide.select(*index, *[F.when(F.array_contains(present, F.lit(v)), F.col(f"__v{i}"))
                                 .otherwise(F.lit(0.0)).alias(v) for i, v in enumerate(values)])


def pivot_sparse(df: DataFrame, index: Sequence[str], column: str, value: str, how: str = "mean",
                 out: str = "cells", block_col: str = "block", max_entries: int = 10_000) -> DataFrame:
    """R6/R9 beyond ``pivotMaxValues``: the wide form with one map (pivot
    value → mean or sum) in place of a column per value.

    An index row's cells are dealt by hash into as many blocks as keep a map
    near ``max_entries`` (one block unless the pivot column has more values),
    so no group grows with the number of values.  Rows with a null pivot value
    are no cell, nor are cells whose values are all null; an index row without
    any cell is absent.  Cells are written once, one row each."""
    agg = {"mean": F.avg, "sum": F.sum}[how]
    cells = df.where(F.col(column).isNotNull()).groupBy(*index, column).agg(agg(value).alias("__cell")).where(F.col("__cell").isNotNull())
    cells = cut_lineage(cells, name="cells")
    n = cells.agg(F.approx_count_distinct(column)).first()[0]
    block = F.pmod(F.xxhash64(column), F.lit(max(1, -(-n // max_entries)))).cast("int")
    entries = F.array_sort(F.collect_list(F.struct(F.col(column).alias("k"), F.col("__cell").alias("v"))))
    return cells.groupBy(*index, block.alias(block_col)).agg(F.map_from_entries(entries).alias(out))


def sparse_columns(wide: DataFrame, index: Sequence[str], values: Mapping[str, object], cells: str = "cells") -> DataFrame:
    """Columns ``{name: pivot value}`` of a sparse wide form, one row per
    index row; null where the row has no such cell."""
    return wide.groupBy(*index).agg(*[F.max(F.try_element_at(F.col(cells), F.lit(v))).alias(c) for c, v in values.items()])


def unpivot_sparse(wide: DataFrame, index: Sequence[str], name_col: str, value_col: str, cells: str = "cells") -> DataFrame:
    """A sparse wide form as one row per cell."""
    return wide.select(*index, F.explode(cells).alias(name_col, value_col))

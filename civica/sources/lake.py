"""Delimited files in a path-based lake.

The lake is any Hadoop-compatible path (``file:``, ``hdfs:``, ``s3a:``),
configured through Spark, not a client library.  Files are read as
strings and typed afterwards with ``try_cast`` so one malformed value
becomes a null instead of failing a 100 TB job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civica.functions.numbers import decimal_comma
from civica.functions.text import light_header
from civica.operators.columns import parse_decimal_columns


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8",
                   header: bool = True, quote: str = '"') -> DataFrame:
    """Read delimited text, every column as a string.  A UTF-8 BOM
    is dropped by the reader; headers keep their spelling (see
    ``civica.operators.columns`` for harmonisation)."""
    return (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
            .option("quote", quote).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))


def read_decimal_comma(spark: SparkSession, path: str, sep: str = ";",
                       numeric: Iterable[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    """S1/S2 + C5: delimited file whose numbers use a decimal comma."""
    df = read_delimited(spark, path, sep)
    df = df.withColumns({c: decimal_comma(c) for c in numeric}) if numeric else df
    return parse_decimal_columns(df, prefixes) if prefixes else df


def read_with_names(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], sep: str = ",",
                    header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Fixed-header reader: positional names given by the caller, the
    file's own header line (possibly duplicated, blank or ragged) skipped."""
    schema = StructType([StructField(n, StringType(), True) for n in names])
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", True)
            .option("sep", sep).option("encoding", encoding).csv(path))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Non-recursive listing of a lake folder (metadata only)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName().endswith(suffix))


# The longest header line that is read, in bytes, and how many files are opened at a time.
HEADER_BYTES = 1 << 20
HEADER_THREADS = 32


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The header line of one file.  The driver opens the file and reads no
    further than that line, and never more than ``HEADER_BYTES``: a longer
    header is an error, not cut."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = jvm.org.apache.commons.io.input.BoundedInputStream(fs.open(p), HEADER_BYTES)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    if len(line.encode(encoding, "replace")) >= HEADER_BYTES:
        raise ValueError(f"{path}: the first line has {HEADER_BYTES} bytes or more")
    return line.lstrip("\ufeff")


def header_lines(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> dict[str, str]:
    """The first line of each file, many files at a time; of the data, one
    block a file is read at most.  Empty files have an empty header."""
    if not files:
        return {}
    with ThreadPoolExecutor(min(HEADER_THREADS, len(files))) as pool:
        return dict(zip(files, pool.map(lambda f: first_line(spark, f, encoding), files)))


def ingest_folder(spark: SparkSession, folder: str, sep: str = ",", suffix: str = ".csv",
                  source_col: str = "source_file") -> dict[str, DataFrame]:
    """Every delimited file directly in ``folder``.  Files are grouped by
    header line so that heterogeneous files never share a schema; each
    group is read in one distributed scan with its file name attached."""
    groups: dict[str, list[str]] = {}
    for f, header in header_lines(spark, list_files(spark, folder, suffix)).items():
        groups.setdefault(header, []).append(f)
    out = {}
    for _hdr, files in groups.items():
        df = read_delimited(spark, files, sep).withColumn(source_col, F.col("_metadata.file_name"))
        out[files[0].rsplit("/", 1)[-1]] = df
    return out


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    decimal_comma_columns: Iterable[str] = (), mode: str = "overwrite") -> None:
    """K1/K9: write delimited text with a header and no index.  Listed
    numeric columns are written with a decimal comma."""
    cols = set(decimal_comma_columns)
    own = {c: F.col(f"`{c}`") for c in df.columns}
    out = df.select(*[F.replace(v.cast("string"), F.lit("."), F.lit(",")).alias(c) if c in cols else v
                      for c, v in own.items()])
    out.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """K6: remove a dataset (file or folder) from the lake."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


# ---------------------------------------------------------------------------
# Ragged lines: decimal commas not quoted in a comma-separated file.
# ---------------------------------------------------------------------------

def repair_decimal_commas(spark: SparkSession, path: str, lead_fields: int = 2,
                          names: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Read a comma file whose decimal commas are unquoted (more fields
    than headers).  After the ``lead_fields`` text fields, every integer
    followed by a one-digit field is joined back into a decimal
    (``47,2`` → ``47.2``).  Returns ``(rows, rejects)``: lines that do not
    give exactly one value per remaining header go to ``rejects``."""
    hdr = [light_header(h) for h in first_line(spark, path).split(",")]
    names = list(names or hdr)
    n_values = len(names) - lead_fields
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line"))
    lines = lines.where(F.col("line") != ",".join(first_line(spark, path).split(",")))
    lead_pat = "^" + ",".join(["([^,]*)"] * lead_fields) + ",(.*)$"
    lead = [F.regexp_extract("line", lead_pat, i + 1) for i in range(lead_fields)]
    tail = F.regexp_extract("line", lead_pat, lead_fields + 1)
    fixed = F.regexp_replace(tail, r"(\d+),(\d)(?=,|$)", "$1.$2")
    vals = F.split(fixed, ",")
    parsed = lines.select("line", *[c.alias(names[i]) for i, c in enumerate(lead)], vals.alias("__v"))
    ok = F.size("__v") == n_values
    good = parsed.where(ok).select(*names[:lead_fields],
                                   *[F.element_at("__v", i + 1).try_cast("double").alias(names[lead_fields + i])
                                     for i in range(n_values)])
    bad = parsed.where(~ok).select("line")
    return good, bad


# ---------------------------------------------------------------------------
# Routed load (K4, K5).
# ---------------------------------------------------------------------------

# Substring of a source name → warehouse target.
ROUTES = {"election": "election", "police": "statistiques_police"}


def table_name(name: str) -> str:
    """K5: ``'Election 2017'`` → ``'election_2017'``."""
    return name.replace(" ", "_").lower()


def route(name: str, routes: Mapping[str, str] = ROUTES) -> str | None:
    """K4: target table chosen by a substring of the normalised name."""
    n = table_name(name)
    for key, target in routes.items():
        if key in n:
            return target
    return None


# The share of the registered that a source's first percentage
# column holds is renamed on load, as candidates have a column of that name.
ROUTED_RENAMES = {"pourcentage_voix_inscrits": "pourcentage_voix_inscrits_election"}


def prepare_routed(df: DataFrame, name: str, election_type: str = "presidentielle",
                   words: Sequence[str] = ("pourcentage", "taux")) -> DataFrame:
    """K4: rename the ambiguous percentage column, add ``annee`` (first
    4-digit number of the name) and ``type_election`` to election sources,
    then parse decimal-comma text in columns whose name holds one of the
    words."""
    df = df.withColumnsRenamed({a: b for a, b in ROUTED_RENAMES.items() if a in df.columns})
    n = table_name(name)
    m = re.search(r"(\d{4})", n)
    if route(name) == "election":
        from civica.operators.columns import with_constants
        df = with_constants(df, annee=int(m.group(1)) if m else None, type_election=election_type)
        df = df.withColumn("annee", F.col("annee").cast("int"))
    return parse_decimal_columns(df, words)


def unique_header_names(names: Sequence[str]) -> list[str]:
    """Repeated headers (one block per candidate) get ``_2``, ``_3`` … in
    order of appearance: ``Nom, Voix, Nom, Voix`` → ``Nom, Voix, Nom_2, Voix_2``;
    blank headers become ``_cN`` (N = position), as Spark names them."""
    seen: dict[str, int] = {}
    out = []
    for i, n in enumerate(names):
        n = n.strip().strip('"')
        if not n:
            out.append(f"_c{i}")
            continue
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return out


def read_repeated_blocks(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", suffix: str = ".csv") -> DataFrame:
    """S1 for files whose candidate blocks repeat the same headers: the
    header line is read by itself and unique positional names are applied to
    a distributed read.  ``path`` is a file, or a folder whose files must all
    have the same header."""
    import csv
    fs, p = _fs(spark, path)
    files = list_files(spark, path, suffix) if fs.getFileStatus(p).isDirectory() else [path]
    headers = set(header_lines(spark, files, encoding).values())
    headers.discard("")
    if len(headers) != 1:
        raise ValueError(f"{path}: one header expected, {len(headers)} found")
    hdr = next(csv.reader(list(headers), delimiter=sep))
    return read_with_names(spark, files, unique_header_names(hdr), sep=sep, encoding=encoding)


def load_routed(df: DataFrame, name: str, database: str, routes: Mapping[str, str] = ROUTES) -> str | None:
    """K4: append a source to the warehouse table its name routes to; a
    name matching no route is reported and skipped (returns None)."""
    import logging
    from civica.sources.warehouse import append_table
    target = route(name, routes)
    if target is None:
        logging.getLogger("civica").warning("no target table for %r", name)
        return None
    t = f"`{database}`.`{target}`"
    append_table(prepare_routed(df, name), t)
    return t


def land_folder(spark: SparkSession, folder: str, out_dir: str, sep: str = ",", suffix: str = ".csv",
                source_col: str = "source_file") -> dict[str, str]:
    """S4 into the lake: every file group of ``folder`` (one group per
    header) written as Parquet partitioned by source file, so later reads
    of one source prune to its partition.  Returns group name → path."""
    out = {}
    for name, df in ingest_folder(spark, folder, sep, suffix, source_col).items():
        path = f"{out_dir}/{table_name(name.rsplit('.', 1)[0])}"
        write_parquet(df, path, partition_by=[source_col])
        out[name] = path
    return out

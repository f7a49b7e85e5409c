"""Exact histogram of encoded lengths, and its suffix sums.

Every document is encoded; each task hands on one row per length, and one
aggregate adds them up.  Sums from each length to the longest then answer
totals, quantiles and truncated totals for every context limit without
another look at the documents.

Defined cases: a null or empty text has length zero and counts; a text of
any length, and any run of white space in it, is encoded whole; texts of equal
length share a row, and repeated rows count as often as they occur; an empty
table has an empty histogram, whose totals are zero and whose quantiles are
null; only the text column is read, whatever other columns are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civica.llm.common import doc_slices, id_and_text
from civica.llm.vocab import ordinary_ids, tiktoken_encoding
from civica.session import cut_lineage

#: Lengths per group of the two-level suffix sums.
GROUP = 1024


def length_histogram(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``length, n_docs`` over all texts, encoded with a tiktoken rank file."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken_encoding(vocabulary, pattern)
        total: Counter[int] = Counter()
        for part in doc_slices(batches):
            total.update(len(ordinary_ids(encoding, t)) for t in part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
                                         names=["length", "n"])

    src = id_and_text(docs, text_col, text_col).select("text")
    return src.mapInArrow(count, "length long, n long").groupBy("length").agg(F.sum("n").alias("n_docs"))


def suffix_sums(histogram: DataFrame, group: int = GROUP) -> DataFrame:
    """Adds to each length the documents and tokens of texts that are at
    least as long, all documents and tokens, the tokens left if texts are cut
    at this length, and the share of documents that fit in it.

    Sums run within groups of ``group`` neighbouring lengths; only one row a
    group goes through the sum over all groups."""
    # Written once: the rows and the groups above them both come from it.
    h = cut_lineage(histogram, name="length-histogram").withColumn("n_tokens", F.col("length") * F.col("n_docs")) \
        .withColumn("_group", F.floor(F.col("length") / F.lit(group)))
    groups = h.groupBy("_group").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    above = Window.orderBy(F.desc("_group"))
    whole = Window.partitionBy()
    groups = groups.select(
        "_group", (F.sum("_docs").over(above) - F.col("_docs")).alias("_docs_above"),
        (F.sum("_tokens").over(above) - F.col("_tokens")).alias("_tokens_above"),
        F.sum("_docs").over(whole).alias("all_docs"), F.sum("_tokens").over(whole).alias("all_tokens"))
    own = Window.partitionBy("_group").orderBy(F.desc("length"))
    out = h.join(groups, "_group").select(
        "length", "n_docs", "n_tokens", (F.sum("n_docs").over(own) + F.col("_docs_above")).alias("docs_at_least"),
        (F.sum("n_tokens").over(own) + F.col("_tokens_above")).alias("tokens_at_least"), "all_docs", "all_tokens")
    fit = F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return out.withColumn("tokens_if_cut", F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")) \
        .withColumn("share_that_fits", fit / F.col("all_docs"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``context, docs_cut, total_tokens``: for each context limit the
    documents longer than it, and the tokens left if they are cut to it."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in dict.fromkeys(limits)], "context long")
    # The suffix that begins with the first length above the limit; few limits, one conditional aggregate each.
    rows = [sums.agg(F.lit(int(x)).cast("long").alias("context"),
                     F.min_by(F.struct("docs_at_least", "tokens_at_least"), F.when(F.col("length") > x, F.col("length"))).alias("s"),
                     F.coalesce(F.max("all_tokens"), F.lit(0).cast("long")).alias("all")) for x in dict.fromkeys(limits)]
    out = asked.select("context").limit(0).select("context", F.lit(0).cast("long").alias("docs_cut"), F.lit(0).cast("long").alias("total_tokens"))
    for r in rows:
        cut = F.coalesce("s.docs_at_least", F.lit(0).cast("long"))
        out = out.union(r.select("context", cut, F.col("all") - F.coalesce("s.tokens_at_least", F.lit(0).cast("long")) + cut * F.col("context")))
    return out


def length_quantiles(sums: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """The smallest length that at least each share of the documents fit in."""
    row = sums.agg(*[F.min(F.when(F.col("share_that_fits") >= q, F.col("length"))).alias(f"q{i}")
                     for i, q in enumerate(shares)]).first()
    return {q: row[i] for i, q in enumerate(shares)}

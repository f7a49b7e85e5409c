"""Literal rows source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from civica.functions.numbers import pct_to_votes


def votes_from_shares(shares: DataFrame, totals: DataFrame, on: Sequence[str], pct: str = "pourcentage",
                      total: str = "exprimes", out: str = "voix") -> DataFrame:
    """votes = percentage × expressed total / 100, totals joined on ``on``."""
    return shares.join(totals, list(on)).withColumn(out, pct_to_votes(pct, total))

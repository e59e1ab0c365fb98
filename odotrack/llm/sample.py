"""Bounded samples of labelled documents, for fitting models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(docs: DataFrame, ids: DataFrame, max_bytes: int, by: str | None = None) -> DataFrame:
    """Whole documents whose ``doc_id`` is in ``ids``: all of them, or so large a share,
    chosen by a hash of the id, that they come to about ``max_bytes`` for each value of
    ``by``. Only the texts of the share are shuffled."""
    group: Sequence[str] = [by] if by else []
    sizes = (
        docs.select("doc_id", *group, F.octet_length("text").alias("n"))
        .join(ids, "doc_id", "left_semi")
        .groupBy(*group)
        .agg(F.sum("n").alias("n"))
        .collect()  # a row per value
    )
    share = F.lit(1.0)
    for *value, n in sizes:
        if n and n > max_bytes:
            here = F.col(by).eqNullSafe(F.lit(value[0])) if by else F.lit(True)
            share = F.when(here, F.lit(max_bytes / n)).otherwise(share)
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)
    return docs.filter(chosen).join(ids, "doc_id", "left_semi")

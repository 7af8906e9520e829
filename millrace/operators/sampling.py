"""Fixed-size sample without replacement, the same rows for the same seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DEPTH = 14  # leading zero digits tried; 16**14 rows per chosen one


def seeded_sample(df: DataFrame, n: int, seed: int, by: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of the columns ``by``.

    ``by`` identifies a row. A row's draw depends on its own values only, so neither partitioning nor a
    recomputed task changes the sample. One counting pass finds the tightest
    draw prefix that still holds ``n`` rows; the ordered limit then sees about
    ``16 n`` rows at most instead of ``n`` from every task. The result is the
    same as ordering everything.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in by])
    drawn = df.withColumn("_draw", F.md5(text))
    sizes = drawn.agg(
        *[F.count_if(F.col("_draw").startswith("0" * d)).alias(f"d{d}") for d in range(1, _DEPTH)]
    ).first()
    depth = max((d for d in range(1, _DEPTH) if sizes[f"d{d}"] >= n), default=0)
    if depth:
        drawn = drawn.where(F.col("_draw").startswith("0" * depth))
    return drawn.orderBy("_draw", *by).limit(n).drop("_draw")

"""Row sampling that does not depend on how rows are laid out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, fraction: float, key: list[str], seed: int = 0) -> DataFrame:
    """Keep each row with probability ``fraction``, decided by a hash of its key.

    A rerun, another partitioning or a retried task keeps the same rows.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(draw < int(fraction * (1 << 32)))

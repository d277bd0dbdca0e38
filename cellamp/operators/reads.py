"""Cut barcode, UMI and qualities out of read pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params


def cut_fields(reads: DataFrame, params: Params = Params()) -> DataFrame:
    """Barcode, its quality string, UMI and the second mate, per read."""
    return reads.select(
        "read_id",
        *params.chunk_cols,
        F.substring("seq_r1", 1, params.bc_len).alias("bc"),
        F.substring("qual_r1", 1, params.bc_len).alias("bc_qual"),
        F.substring("seq_r1", params.bc_len + 1, params.umi_len).alias("umi"),
        "seq_r2",
        "qual_r2",
    )

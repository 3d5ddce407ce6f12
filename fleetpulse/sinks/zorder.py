"""Clustering by several columns at once (Z-order), so that a filter on any one of them
skips files.

Every column's values become ranks between equally filled ranges (bounds by one approximate-percentile
aggregate, map-side), and the bits of the ranks are interleaved into one key. Rows are
range-partitioned and sorted by that key: a file holds a small box of all columns, and its Parquet
minima and maxima tell a reader whether it can hold a value.

The rows are read for the bounds, by the range partitioning's sample and for the write: stage what
is dear to compute. Ranks only order the rows: values between the same bounds, and text that is
equal in the first seven bytes after the column's common prefix, share one; NULL ranks lowest.
"""

from __future__ import annotations

import os.path
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sizing import partitions_for

#: Ranges per column: 2 ** BITS.
BITS = 6


def _as_number(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """An order-preserving number per column."""
    types = dict(df.dtypes)
    texts = [c for c in columns if types[c] == "string"]
    ends = df.agg(*[F.min(c).alias(f"lo_{c}") for c in texts], *[F.max(c).alias(f"hi_{c}") for c in texts]).first() if texts else {}
    out = {}
    for c in columns:
        if types[c] == "string":
            shared = len(os.path.commonprefix([ends[f"lo_{c}"] or "", ends[f"hi_{c}"] or ""]))
            digits = F.rpad(F.substring(F.hex(F.substring(c, shared + 1, 7)), 1, 14), 14, "0")
            out[c] = F.conv(digits, 16, 10).cast("double")
        elif types[c].startswith("timestamp"):
            out[c] = F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        elif types[c] == "date":
            out[c] = F.unix_date(c).cast("double")
        else:
            out[c] = F.col(c).cast("double")
    return out


def _rank(number: Column, bounds: list[float]) -> Column:
    """How many bounds lie below the number, found by halving (NULL: none)."""
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        return F.when(number > F.lit(bounds[mid]), among(mid + 1, hi)).otherwise(among(lo, mid))

    return among(0, len(bounds))


def z_key(df: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """The rows with the interleaved ranks of the columns as one long, ``_z`` (``bits`` times columns
    at most 62). Numbers and ranks are columns of their own on the way: each is computed once a row."""
    if bits * len(columns) > 62:
        raise ValueError("bits times columns must be at most 62")
    at = range(len(columns))
    numbers = _as_number(df, columns)
    numbered = df.withColumns({f"_number_{j}": numbers[c] for j, c in enumerate(columns)})
    shares = [k / 2 ** bits for k in range(1, 2 ** bits)]
    bounds = numbered.agg(*[F.percentile_approx(f"_number_{j}", shares, 1000) for j in at]).first()
    ranked = numbered.withColumns({f"_rank_{j}": _rank(F.col(f"_number_{j}"), bounds[j] or []) for j in at})
    parts = [F.shiftleft(F.shiftright(f"_rank_{j}", i).bitwiseAND(F.lit(1).cast("long")), i * len(columns) + j)
             for j in at for i in range(bits)]
    keyed = ranked.withColumn("_z", reduce(lambda a, b: a.bitwiseOR(b), parts))
    return keyed.drop(*[f"_{what}_{j}" for what in ("number", "rank") for j in at])


def write_zordered(df: DataFrame, path: str, columns: list[str], partition_by: tuple[str, ...] = (), fmt: str = "parquet",
                   num_partitions: int | None = None, bits: int = BITS) -> None:
    """Overwrite a table whose files are boxes of ``columns`` (inside ``partition_by`` directories)."""
    keyed = z_key(df, columns, bits)
    laid = keyed.repartitionByRange(partitions_for(df, num_partitions), *partition_by, "_z").sortWithinPartitions(*partition_by, "_z")
    laid.drop("_z").write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)

"""Column compression report (M5): gzip a text column over the whole table,
check that every value round-trips, and report bytes before and after.

Spark has no gzip SQL function, so each partition compresses its own rows
in Python (Arrow batches via ``mapInPandas``); only per-partition sums leave
the tasks and the final sums are one small aggregate.
"""

from __future__ import annotations

import gzip
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = T.StructType([T.StructField("column", T.StringType()), T.StructField("rows", T.LongType()),
                      T.StructField("nulls", T.LongType()), T.StructField("raw_bytes", T.LongType()),
                      T.StructField("gzip_bytes", T.LongType()),
                      T.StructField("bad_roundtrips", T.LongType())])


def _compress_partition(cols: list[str]):
    def run(batches):
        totals = {c: [0, 0, 0, 0, 0] for c in cols}
        for pdf in batches:
            for c in cols:
                acc = totals[c]
                for v in pdf[c]:
                    acc[0] += 1
                    if v is None or (isinstance(v, float) and pd.isna(v)):
                        acc[1] += 1
                        continue
                    raw = str(v).encode("utf-8")
                    packed = gzip.compress(raw, compresslevel=6, mtime=0)
                    acc[2] += len(raw)
                    acc[3] += len(packed)
                    if gzip.decompress(packed) != raw:
                        acc[4] += 1
        yield pd.DataFrame([{"column": c, "rows": v[0], "nulls": v[1], "raw_bytes": v[2],
                             "gzip_bytes": v[3], "bad_roundtrips": v[4]} for c, v in totals.items()])

    return run


def compression_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: rows, NULLs, UTF-8 bytes, gzip bytes, values that
    failed to round-trip and the saving in percent."""
    from tessera.session import ship_package

    ship_package(df.sparkSession)
    parts = df.select(*cols).mapInPandas(_compress_partition(list(cols)), _PART)
    agg = parts.groupBy("column").agg(*[F.sum(c).cast("long").alias(c) for c in
                                        ("rows", "nulls", "raw_bytes", "gzip_bytes", "bad_roundtrips")])
    return agg.withColumn("saving_pct", F.round(
        F.when(F.col("raw_bytes") > 0, 100.0 * (1 - F.col("gzip_bytes") / F.col("raw_bytes"))), 2))

"""How much of a table a Python worker is given at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows and bytes of an Arrow batch.
MOST = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def small(df: DataFrame) -> DataFrame:
    """df, whose session now hands rows on to Python in small batches: 10,000 rows, the default, are as large as their texts are, and
    a worker holds several copies of them. Settings that are smaller already stay."""
    conf = df.sparkSession.conf
    for key, most in MOST.items():
        value = str(conf.get(key)).lower().removesuffix("b")
        if not value.isdigit() or not 0 < int(value) <= most:
            conf.set(key, str(most))
    return df

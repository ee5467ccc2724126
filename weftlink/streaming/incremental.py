"""Extension: match new S2 or S3 records, as they arrive, against the persisted keys of S1.

A stream-static join: the data model has no event time, so there is no watermark; each micro-batch is ranked by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking as B
from ..operators.normalise import blocking_columns, normalise


def batch_matches(batch: DataFrame, s1_keys: DataFrame) -> DataFrame:
    """cand, s1, agreement of the records of one micro-batch; s1_keys: country, family, key, s1."""
    rows = blocking_columns(normalise(batch))
    keys = B.probes(rows).withColumnRenamed("s1", "cand")
    bit = F.create_map(*[x for f, b in B.BIT.items() for x in (F.lit(f), F.lit(b))])
    found = keys.join(s1_keys, ["country", "family", "key"]).groupBy("cand", "s1").agg(F.bit_or(bit[F.col("family")]).alias("mask"))
    return found.select("cand", "s1", F.bit_count("mask").cast("bigint").alias("agreement"))


def match_stream(stream: DataFrame, s1_keys: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the matches of every micro-batch to a Parquet table; a batch that is repeated after a failure overwrites itself."""

    def each(batch: DataFrame, number: int) -> None:
        batch_matches(batch, s1_keys).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Tables that lie in buckets of a key, so that joins on it need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from .shared import new_path


def bucketed(rows: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``rows`` written once in sorted buckets of ``key`` and read back.

    Two tables with as many buckets join on the key bucket by bucket. Rows are dealt out by the key
    before they are written, so that a bucket is one file; a key with a very large share of the
    rows makes one large bucket, so keys should be ids.
    """
    table = f"loomstat_{name}_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", new_path(rows.sparkSession, name)).saveAsTable(table)
    return rows.sparkSession.table(table)

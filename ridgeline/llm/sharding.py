"""Sharding by longest-processing-time scheduling.

Groups that must stay together (equal texts) are sorted by size, and each goes to the least-loaded shard, which a heap
gives. The law it holds is `bytes`: the shards' sizes are as near equal as groups allow.

At scale there are about as many groups as documents, more than one heap on the driver should see. Groups are therefore
first gathered by a hash of their key into `bundles` bundles; a group of more than `LARGE` average bundles is scheduled
on its own. The driver gets at most `bundles * (1 + 1 / LARGE)` sizes, whatever the input. The spread of the
shards' sizes is at most the largest scheduled item.

Defined results: a null text has no bytes (size 1, crc32 0) and forms a group of its own with other nulls, as the empty
text does with empty texts; repeated rows stay together; slots follow a hash of the row, then the id. Extra columns
are ignored. An empty table gives no row.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import numbered, pruned

BUNDLES = 8192
LARGE = 4


def schedule(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Longest processing time first: (size, item) to shard. Ties: the smaller item first, the lower shard first."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard(docs: DataFrame, shards: int = 8, bundles: int = BUNDLES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of docs."""
    spark = docs.sparkSession
    raw = F.col("text").cast("binary")
    rows = pruned(docs).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(raw, 256), F.lit("null")).alias("key"),
    )
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int"))
    sums = {r.bundle: r.bytes for r in rows.groupBy("bundle").agg(F.sum("size").alias("bytes")).collect()}
    limit = LARGE * sum(sums.values()) / bundles
    full = [b for b, n in sums.items() if n > limit]  # at most bundles / LARGE
    own: dict[str, int] = {}
    if full:
        among = spark.createDataFrame([(b,) for b in full], "bundle int")
        groups = rows.join(F.broadcast(among), "bundle").groupBy("bundle", "key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > limit)
        for r in groups.collect():  # at most bundles / LARGE
            own[r.key] = r.bytes
            sums[r.bundle] -= r.bytes
    items = [(n, (0, b, "")) for b, n in sums.items() if n] + [(n, (1, 0, k)) for k, n in own.items()]
    placed = schedule(items, shards)
    by_bundle = spark.createDataFrame([(b, s) for (kind, b, _), s in placed.items() if not kind], "bundle int, by_bundle int")
    by_key = spark.createDataFrame([(k, s) for (kind, _, k), s in placed.items() if kind], "key string, by_key int")
    dealt = rows.join(F.broadcast(by_bundle), "bundle", "left").join(F.broadcast(by_key), "key", "left")
    dealt = dealt.select("doc_id", "size", "text_crc32", F.coalesce("by_key", "by_bundle").alias("shard"))
    slots = numbered(dealt, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

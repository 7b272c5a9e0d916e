"""Exact dedup with an extendible-hash index on shared files; DataFrame functions only.

* Entries: equal hash *and* equal bytes are one entry. Copies are combined before
  the shuffle, so a text that a third of all rows share is one row per map task.
* Chains: the entries of one hash value, which are different texts that collide.
* Directory: 2 ** ``max_depth`` pointers at most. A bucket that holds more than
  ``capacity`` entries splits on its next hash bit, which doubles the directory.
* Owners: the index is range-partitioned by bucket and written to shared files.
* Lookup: a row finds its bucket through the directory and its hash in the bucket.
  A chain of one entry needs no comparison, since all rows of that hash had equal
  bytes; rows of a longer chain are told apart by their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def directory(index: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """``slot`` (first ``max_depth`` hash bits) to ``bucket``, after all splits.

    A slot's bucket has the least depth at which it holds ``capacity`` entries or
    fewer, which is where repeated splitting stops. ``bucket`` is 1, then the bits.
    """
    slots = index.groupBy("slot").agg(F.count("*").alias("entries"))
    depths = slots.select("slot", "entries", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    bits = f"cast(shiftleft(1L, depth) + shiftright(slot, {max_depth} - depth) AS bigint)"
    sized = depths.withColumn("bucket", F.expr(bits))
    held = sized.groupBy("bucket").agg(F.sum("entries").alias("held"))
    fits = (F.col("held") <= capacity) | (F.col("depth") == max_depth)
    return (
        sized.join(held, "bucket")
        .where(fits)
        .groupBy("slot")
        .agg(F.min("bucket").alias("bucket"))  # the shallowest bucket has the smallest number
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    max_depth: int = 16,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; a null text is
    the empty text. The largest id of a group stays; repeated rows of that id all
    have ``kept``. A null id never stays beside another id; a group of null ids has
    a null ``keep_id`` and keeps all. Other columns of ``docs`` are not looked at.
    An empty table gives no rows. ``hash_bits`` below 64 makes collisions (tests).
    """
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    hashed = F.shiftrightunsigned(F.xxhash64("text"), 64 - hash_bits)
    slot = F.shiftrightunsigned("hash", hash_bits - max_depth).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("hash", hashed)

    entries = rows.groupBy("hash", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    chained = entries.groupBy("hash").agg(
        F.count("*").alias("links"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    index = stored(chained.withColumn("slot", slot), "dedup-chains")
    # 2 ** max_depth rows of two numbers at most, whatever the number of entries.
    pointers = F.broadcast(stored(directory(index, capacity, max_depth), "dedup-directory"))
    owned = stored(
        index.join(pointers, "slot").drop("slot").repartitionByRange("bucket", "hash").sortWithinPartitions("bucket", "hash"),
        "dedup-index",
    )

    keyed = rows.select("id", "hash", F.sha2("text", 256).alias("text_sha256"), slot.alias("slot"))
    keyed = keyed.join(pointers, "slot").drop("slot")
    found = keyed.join(owned.where("links = 1"), ["bucket", "hash"])
    collided = owned.where("links > 1").select("hash")
    out = found.select("id", "keep_id", "group_size", "text_sha256")
    if not collided.isEmpty():
        again = rows.join(collided, "hash", "left_semi")
        texts = again.groupBy("hash", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        compared = again.join(texts, ["hash", "text"])
        out = out.unionByName(compared.select("id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")))
    return out.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

"""Operator 12: exact de-duplication by an extendible-hash index on shared files.

Every text (A-Z lower-cased, nothing else changed) has a 64-bit hash.  One row
per hash, with what its documents have in common already added up, is the key
of an index.  A directory of slots, the first bits of a hash, says how many of
those bits tell a key's bucket: all slots start in one bucket, and as long as a
bucket holds more keys than its capacity the directory is doubled, which splits
the overfull buckets by one bit more and leaves the others shared between slots.
The index is written in the order of its buckets, so that each owner task has a
range of keys, as Parquet in the shared checkpoint folder.

An equal hash is no proof.  Texts of every hash that several documents have are
compared byte by byte, copies collapsing before they are moved; the owner of the
bucket chains the different texts that share a hash.  Only documents of such a
chain are looked up by their text; all others need their hash alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm.common import cut

#: Keys that a bucket holds before it is split.
CAPACITY = 16_384
#: Hashes of several documents up to this number (8 MB) are broadcast to the texts; more are joined plainly.
BROADCAST_KEYS = 1_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased; a null text is empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(whole) == F.length(whole)  # there lower() changes nothing but A-Z, and is faster
    return F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, _UPPER, _UPPER.lower()))


def _slot(h: Column, bits: int) -> Column:
    """The first ``bits`` bits of a hash."""
    return F.shiftrightunsigned(h, 64 - bits)


def _bucket(depth: Column, bits: int) -> Column:
    """First slot of the bucket that a slot belongs to, of so many bits as ``depth`` says."""
    low = (F.lit(bits) - depth).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", F.col("slot"), low), low)


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Columns slot, n (keys) and depth (bits that tell the slot's bucket), and the
    number of bits of a slot.

    ``keys`` has one row for each hash ``h``.  The number of slots grows with the
    number of keys, sixteen or more for each bucket's worth of them.  A bucket of
    a single slot that is overfull stays so, as no bits are left to split it by."""
    bits = max(keys.count() // capacity, 1).bit_length() + 4
    slots = keys.groupBy(_slot(F.col("h"), bits).alias("slot")).agg(F.count("*").alias("n"))
    slots = cut(slots.withColumn("depth", F.lit(0)))
    for depth in range(bits):
        held = slots.where(F.col("depth") == depth).withColumn("bucket", _bucket(F.lit(depth), bits))
        full = held.groupBy("bucket").agg(F.sum("n").alias("held")).where(F.col("held") > capacity).select("bucket")
        full = cut(full.withColumn("depth", F.lit(depth)))
        if full.isEmpty():
            break
        doubled = slots.withColumn("bucket", _bucket(F.col("depth"), bits)).join(
            full.withColumn("split", F.lit(1)), ["bucket", "depth"], "left"
        )
        slots = cut(doubled.select("slot", "n", (F.col("depth") + F.coalesce("split", F.lit(0))).alias("depth")))
    return slots, bits


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    key: Callable[[Column], Column] = F.xxhash64,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Per row of ``docs``: the id, keep_id (id of the row that stays), group_size
    (rows of the same text), kept and text_sha256 (of the normalised text).

    Texts are equal when they are identical after lower-casing A-Z.  Of equal
    texts the row of the largest id stays; of several with that id, or of a group
    without any id (its keep_id is null), exactly one.  A null text is an empty
    one, repeated rows are copies, an empty table gives an empty result, other
    columns are not read.  ``key`` is the hash, a long; texts that share one are
    told apart by their bytes, whatever it is."""
    plain = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    rows = cut(
        plain.select(
            "id", F.monotonically_increasing_id().alias("rid"), key(F.col("text")).alias("h"), F.sha2("text", 256).alias("sha")
        )
    )
    # of the rows with the largest id any one stays; written, so that it is always the same
    stays = F.coalesce(F.max_by("rid", "id"), F.min("rid")).alias("keep_rid")
    facts = [F.count("*").alias("n"), F.max("id").alias("keep_id"), stays]
    keys = cut(rows.groupBy("h").agg(*facts))
    slots, bits = directory(keys, capacity)
    placed = keys.withColumn("slot", _slot(F.col("h"), bits)).join(slots.select("slot", "depth"), "slot")
    placed = placed.withColumn("bucket", _bucket(F.col("depth"), bits)).drop("slot")
    index = cut(placed.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h"))

    # the bytes of hashes that several documents have
    twice = index.where("n > 1").select("h", "bucket")
    if twice.count() <= broadcast_keys:
        twice = F.broadcast(twice)
    texts = plain.select("text", key(F.col("text")).alias("h")).join(twice, "h")
    entries = texts.groupBy("bucket", "h", "text").agg(F.count("*").alias("n"))
    owned = entries.repartitionByRange("bucket", "h")
    chain = F.row_number().over(W.partitionBy("bucket", "h").orderBy("text"))
    links = cut(owned.withColumn("link", chain).where("link > 1").select("h").distinct())

    found = rows.join(index.select("h", "n", "keep_id", "keep_rid"), "h")
    columns = [
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").cast("long").alias("group_size"),
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    ]
    if links.isEmpty():
        return found.select(*columns)
    # different texts of one hash: these documents are looked up by their text
    chained = plain.withColumn("h", key(F.col("text"))).withColumn("sha", F.sha2("text", 256)).join(links, "h", "left_semi")
    chained = cut(chained.withColumn("rid", F.monotonically_increasing_id()))
    groups = cut(chained.groupBy("h", "text").agg(*facts))
    again = chained.join(groups, ["h", "text"])
    return found.join(links, "h", "left_anti").select(*columns).unionByName(again.select(*columns))


SQL = f"""
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')) AS text_sha256 FROM documents
)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256)
"""

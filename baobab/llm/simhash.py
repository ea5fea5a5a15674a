"""Operator 4: SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint belongs to class ``1 + i mod (2^(r+1) - 1)``, a nonzero
vector of r+1 bits; table v (each nonzero vector) keeps the bits whose class has
an odd inner product with v.  Any r differing bits leave some v orthogonal to
all their classes, so two fingerprints within radius r agree on all bits of some
table: no pair is missed, by construction and not by chance.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.llm.bpe import blocks
from baobab.llm.common import cut
from baobab.llm.components import components

BITS = 64
#: Distinct fingerprints up to which a bucket is compared within itself; larger
#: ones are split by more bits first (see ``covering_links``).
BUCKET = 256


def fingerprint_of(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: bit 1 if set in over half of the
    XXH64 of its word shingles (fewer words: of the whole sequence; none: 0)."""
    words = data.lower().split()  # on bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    runs = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    count = np.zeros(BITS, dtype=np.int64)
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), dtype=np.uint64, count=n)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Columns id and fp (the fingerprint's bits as a signed long) per row."""

    def run(batches):
        for block in blocks(batches):
            texts = block.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint_of(t or b"", shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 structured masks."""
    classes = (1 << (radius + 1)) - 1
    kind = [1 + i % classes for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (kind[i] & v).bit_count() % 2) for v in range(1, classes + 1)]


def refine(mask: int, radius: int, bits: int = BITS) -> list[int]:
    """``mask`` with each of radius+1 equal parts of the bits that it leaves
    out: two fingerprints that differ in at most ``radius`` of them agree on a part."""
    rest = [i for i in range(bits) if not mask >> i & 1]
    return [mask | sum(1 << i for i in rest[k :: radius + 1]) for k in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_links(fps: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """All pairs a < b of the distinct values ``fps.fp`` at most ``radius`` bits apart.

    Buckets of one fingerprint are dropped before anything is paired.  Those of
    more than ``bucket`` are not compared within themselves: they are split into
    radius+1 buckets by more bits each, as often as bits are left to split by.
    At radius 2 that is three times (27 or 28 bits left out, in the end 8 or 9), so
    that no bucket that is compared holds more than 2^9 fingerprints, however
    many documents there are."""
    level = covering_masks(radius)
    keyed = fps.select(
        "fp",
        F.explode(
            F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(level)))
        ).alias("x"),
    ).select("fp", "x.t", "x.key")
    links = None
    while True:
        sizes = cut(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
        keyed = cut(keyed.join(sizes, ["t", "key"]))
        last = min(BITS - m.bit_count() for m in level) <= max(radius, bucket.bit_length() - 1)
        small = keyed if last else keyed.where(F.col("n") <= bucket)
        a = small.select("t", "key", F.col("fp").alias("a"))
        b = small.select("t", "key", F.col("fp").alias("b"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
        found = a.join(b, ["t", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
        links = found if links is None else links.unionByName(found)
        large = keyed.where(F.col("n") > bucket)
        if last or large.isEmpty():
            return links.distinct()
        finer = [refine(m, radius) for m in level]
        options = F.array(*(F.array(*(F.lit(_signed(x)) for x in masks)) for masks in finer))
        keyed = large.select("fp", F.col("t").alias("old"), F.posexplode(F.element_at(options, F.col("t") + 1))).select(
            "fp",
            (F.col("old") * (radius + 1) + F.col("pos")).cast("int").alias("t"),
            F.col("fp").bitwiseAND(F.col("col")).alias("key"),
        )
        level = [x for masks in finer for x in masks]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """Per row of ``docs``: the id, fingerprint (16 lower-case hex digits) and
    component_id, the smallest id reached over links of at most ``radius`` bits.

    Null and empty texts have fingerprint zero and are linked like any other.
    Equal fingerprints are one node, so copies are never paired with each other;
    repeated rows keep a row each; rows with a null id are linked but never name
    a component (component_id is null if no id in it is known).  An empty table
    gives an empty result.  Other columns are not read."""
    each = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = cut(each.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(covering_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    of_fp = rooted.join(named, "root").select(F.col("fp").alias("node"), "component_id")
    return (
        each.join(of_fp, each.fp == of_fp.node, "left")
        .select(
            F.col("id").alias(id_col),
            F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
            "component_id",
        )
    )

"""SimHash near-duplicates by anchor points of a covering code.

1. A fingerprint holds, bit by bit, the majority of the hashes of a text's word shingles.
2. The anchors are the words of the Hamming code on bits 1 to 63, with bit 64 free: a code of covering
   radius 1, so every fingerprint is an anchor or one bit from exactly one.
3. A pair at two bits or fewer has a word between them that is one bit from both at most, and the anchor of this
   word is within 1 (radius) + 1 (half of the threshold) bits of both. So every fingerprint goes to the 33
   anchors of the words at one bit or fewer. The plain bound, radius + threshold on one side, would take 684.
4. Fingerprints are compared on each anchor. An anchor lies near 2,081 different fingerprints at most, whatever
   the data: no group grows with the corpus. Links are joined to components; equal fingerprints are one node.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from claimforge.llm.common import connected_components, store

#: Bits in which linked fingerprints differ at most.
DISTANCE = 2
SHINGLE = 3
SEED = 42
#: Shingles whose hashes are held at a time.
CHUNK = 65_536

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def majority(counts: np.ndarray, n: int) -> int:
    """The 64-bit word of the bits that are set in more than half of ``n`` hashes."""
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit; sums of up to 255 run in eight bytes of a word at once."""
    lanes = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
    parts = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return parts.view(np.uint8).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of a whole UTF-8 text, 0 without words; hashes pass in chunks of bounded size."""
    flat = SPACE.sub(b" ", text.lower()).strip(b" ")  # bytes.lower changes A-Z only
    if not flat:
        return 0
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(flat))
    n = max(1, len(starts) - size + 1)
    starts, ends = starts[:n], ends[min(size, len(ends)) - 1 :]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        pairs = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist(), strict=True)
        counts += bit_counts(np.fromiter((digest(flat[a:b], SEED) for a, b in pairs), np.uint64))
    return majority(counts, n)


@F.arrow_udf(LongType())
def simhash(texts: pa.Array) -> pa.Array:
    made = np.fromiter((fingerprint(t.as_py() or b"") for t in texts.cast(pa.binary())), np.uint64, len(texts))
    return pa.array(made.view(np.int64))


def anchors(fp: Column) -> Column:
    """The distinct anchors of all words at one bit or fewer from ``fp``.

    Bits 1 to 63 are numbered from the lowest. The syndrome of a word is the exclusive or of the numbers of
    its bits; the anchor of a word flips the bit that its syndrome names, none if that is 0. Flipping bit p first
    makes the syndrome s xor p, so the anchor of that word flips p and s xor p, and p = 0 stands for no flip.
    """
    parities = [((F.bit_count(fp.bitwiseAND(F.lit(sum(1 << (p - 1) for p in range(1, 64) if p >> j & 1)))) % 2).cast("int")) * (1 << j) for j in range(6)]
    syndrome = sum(parities[1:], parities[0])
    bit = lambda p: F.when(p == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), p - 1))
    # let() for the syndrome: a one-element array, so that it is computed once for each row
    near = F.transform(F.array(syndrome), lambda s: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda p: fp.bitwiseXOR(bit(p)).bitwiseXOR(bit(p.bitwiseXOR(s)))))
    own = fp.bitwiseXOR(bit(syndrome))
    return F.array_distinct(F.concat(F.array(own, own.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))), F.flatten(near)))


def links(fps: DataFrame, fp: str = "fp", distance: int = DISTANCE) -> DataFrame:
    """``(a, b)``: pairs of distinct fingerprints at ``distance`` bits or fewer (2 at most), met on an anchor.

    A pair is found on each anchor that both have.
    """
    if not 1 <= distance <= 2:
        raise ValueError("anchors are within reach of pairs at one or two bits")
    near = fps.select(F.col(fp).alias("a"), F.explode(anchors(F.col(fp))).alias("anchor"))
    other = near.select(F.col("a").alias("b"), F.col("anchor").alias("other"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # Spark sizes the 33 rows of a fingerprint as one and would broadcast them
    return near.join(other.hint("merge"), (F.col("anchor") == F.col("other")) & (F.col("a") < F.col("b")) & close).select("a", "b")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row of ``docs``.

    Words are what white space of ASCII separates, with A-Z in lower case; fewer words than a shingle are one
    shingle. Null, empty and blank texts have fingerprint 0 and are linked like any other. Texts are read whole.
    The component is the least id that links reach; a row without an id has the least id of its component too,
    null if no row of it has one. Repeated rows stay, each with the same result. Other columns are not carried.
    An empty table gives an empty one.
    """
    rows = store(docs.select(docs[doc_id].alias("doc_id"), simhash(docs[text]).alias("fp")), "fingerprints")
    held = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "held")
    roots = connected_components(links(held, distance=distance))
    named = held.join(roots, held.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    names = named.select("fp", "root").join(best, "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and the components of those at two bits or fewer."""
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

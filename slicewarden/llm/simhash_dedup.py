"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints are cut into so few segments that two within ``max_bits`` differ
by at most one bit in some segment (two segments for 3 bits).  Each segment is
indexed once per bit with that bit wildcarded; two segments share a variant
exactly if they differ in that bit at most.  An equality join on the variants
proposes pairs, the bit count of the xor verifies them, and linked
fingerprints are grouped into components.

Copies with one fingerprint meet in one row before the join, so exact copies
cost nothing there.  Variants shared by more than ``dense`` fingerprints are
joined on a byte of the remaining bits as well, for every such byte: there are
more of them than ``max_bits``, so one agrees and no link is lost.

Defined cases: a null or empty text has fingerprint zero and links like any
other; rows with a null id take part and get the smallest id they reach, null
if none; repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import bound_batches, stored, utf8

BITS = 64
BLOCK = 16_384                   # shingles counted at once


def fingerprint(data: bytes, shingle: int, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a UTF-8 text's word shingles."""
    import xxhash

    words = data.lower().split()         # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    m = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, m, BLOCK):
        hi = min(m, lo + BLOCK)
        if m == 1:
            hashes = [hash_of(b" ".join(words), seed)]
        else:
            part = [words[lo + k:hi + k] for k in range(shingle)]
            hashes = [hash_of(b" ".join(s), seed) for s in zip(*part)]
        grid = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(grid, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > m, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(df: DataFrame, text_col: str, shingle: int, out: str = "fp") -> DataFrame:
    bound_batches(df.sparkSession)

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in texts], pa.int64())

    return df.withColumn(out, run(utf8(F.col(text_col))))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def segments(max_bits: int) -> list[int]:
    """Bit masks of the segments: with ``n`` of them, ``max_bits`` differing
    bits leave one with ``max_bits // n`` <= 1."""
    n = max_bits // 2 + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [sum(1 << b for b in range(cuts[k], cuts[k + 1])) for k in range(n)]


def _verified(max_bits: int) -> Column:
    """Within the distance, and proposed by this variant alone: the segment
    differs in the wildcarded bit only, or not at all and it is its first."""
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    here = diff.bitwiseAND(F.col("a.segment"))
    return ((F.col("a.fp") < F.col("b.fp")) & (F.bit_count(diff) <= max_bits)
            & ((here == F.col("a.wild")) | ((here == 0) & F.col("a.first"))))


def links(fps: DataFrame, max_bits: int, dense: int = 1024) -> DataFrame:
    """Pairs (x < y) of distinct fingerprints (column ``fp``) at most
    ``max_bits`` bits apart."""
    variants = []
    for mask in segments(max_bits):
        bits = [b for b in range(BITS) if mask >> b & 1]
        for b in bits:
            variants.append(F.struct(F.lit(_signed(mask)).alias("segment"), F.lit(_signed(1 << b)).alias("wild"),
                                     F.lit(b == bits[0]).alias("first")))
    keyed = (fps.select("fp", F.explode(F.array(*variants)).alias("v")).select("fp", "v.*")
             .withColumn("key", F.xxhash64(F.col("fp").bitwiseAND(F.col("segment"))
                                           .bitwiseAND(F.bitwise_not(F.col("wild"))), "segment", "wild")))
    # One shuffle of the variants serves the counts and both sides of the join.
    keyed = keyed.repartition("key")
    counts = keyed.groupBy("key").count().where("count > 1")
    near = keyed.join(counts, "key")
    outside = min(sum((0xFF << 8 * k) & ~mask != 0 for k in range(8)) for mask in segments(max_bits))
    if outside <= max_bits:          # the bytes could all differ; variants this long stay thin
        dense = 1 << 62
    thin = near.where(F.col("count") <= dense)
    pairs = (thin.alias("a").join(thin.alias("b"), (F.col("a.key") == F.col("b.key")) & _verified(max_bits))
             .select(F.col("a.fp").alias("x"), F.col("b.fp").alias("y")))
    # A dense variant is joined per byte outside its segment.
    rest = F.col("fp").bitwiseAND(F.bitwise_not(F.col("segment")))
    byte = [F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(rest, 8 * k).bitwiseAND(F.lit(255)).alias("byte"),
                     F.lit(_signed(0xFF << 8 * k)).alias("at")) for k in range(8)]
    thick = near.where(F.col("count") > dense).select("*", F.explode(F.array(*byte)).alias("s"))
    thick = thick.where(F.col("segment").bitwiseAND(F.col("s.at")) != F.col("s.at")).select("*", "s.k", "s.byte")
    more = (thick.alias("a").join(thick.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.k") == F.col("b.k"))
                                  & (F.col("a.byte") == F.col("b.byte")) & _verified(max_bits))
            .select(F.col("a.fp").alias("x"), F.col("b.fp").alias("y")))
    return pairs.union(more).distinct() if outside > max_bits else pairs.distinct()


def component_labels(pairs: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint each linked one reaches.

    Each round takes the smallest label among the neighbours and then the
    label of that label, so chains shrink by halves; the rounds' tables are
    written to the shared folder.
    """
    both = stored(pairs.select(F.col("x").alias("fp"), F.col("y").alias("to"))
                  .union(pairs.select(F.col("y"), F.col("x"))), "links")
    labels = stored(both.groupBy("fp").agg(F.least(F.min("to"), F.col("fp")).alias("root")), "labels")
    while True:
        seen = labels.select(F.col("fp").alias("to"), F.col("root").alias("near"))
        around = both.join(seen, "to").groupBy("fp").agg(F.min("near").alias("near"))
        step = stored(labels.join(around, "fp")
                      .select("fp", F.least("root", "near").alias("root"), F.col("root").alias("was")), "labels")
        over = step.select(F.col("fp").alias("root"), F.col("root").alias("far"))
        new = stored(step.join(over, "root").select("fp", F.least("root", "far").alias("root"), "was"), "labels")
        changed = new.where("root <> was").limit(1).count()
        labels = new.select("fp", "root")
        if not changed:
            return labels


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_bits: int = 3, dense: int = 1024) -> DataFrame:
    """One row per row of ``df``: id, text hash, fingerprint (16 hex digits)
    and component_id, the smallest id reachable over links."""
    prints = stored(with_fingerprint(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                     "text", shingle)
                    .select("doc_id", F.xxhash64("text").alias("text_hash"), "fp"), "fingerprints")
    heads = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("head")), "heads")
    pairs = stored(links(heads.select("fp"), max_bits, dense), "pairs")
    labels = component_labels(pairs)
    firsts = labels.join(heads, "fp").groupBy("root").agg(F.min("head").alias("first"))
    grouped = stored(heads.join(labels, "fp", "left").join(stored(firsts, "firsts"), "root", "left")
                     .select("fp", F.coalesce("first", "head").alias("component_id")), "components")
    return (prints.join(grouped, "fp")
            .select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3
             ) -> DataFrame:
    """``df`` with one row of each component: the smallest id, then text hash;
    rows without an id come last."""
    found = stored(simhash_components(df, id_col, text_col, shingle, max_bits), "found")
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint"))]
    chosen = found.groupBy(*[g.alias(f"g{k}") for k, g in enumerate(group)]).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("row"))
    chosen = stored(chosen.select("row.doc_id", "row.text_hash"), "chosen")
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"))
    kept = rows.join(chosen, rows["_id"].eqNullSafe(chosen["doc_id"]) & (rows["_hash"] == chosen["text_hash"]),
                     "left_semi")
    if found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["_id", "_hash"])        # a row repeated as a whole stays once
    return kept.select("row.*")

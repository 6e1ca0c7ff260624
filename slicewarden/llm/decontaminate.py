"""Benchmark decontamination: broadcast hash set of test n-grams, native.

Texts are normalised to lower-case (A-Z) words.  Every window of ``window``
consecutive words of a benchmark item (an item with fewer words is one window)
goes into a set.  A bit array of the windows' hashes screens every window of
every document inside the scan; the windows that pass are compared word for
word with the set by a hash join, so a hit is exact.

The bit array has a bounded size; the window table is broadcast only while it
counts at most ``BROADCAST_WINDOWS`` rows, and is a plain join side beyond.

Defined cases: a null or empty text has no words and no hits; an item without
words is no window; an item with a null id marks words but is not listed; items
that repeat an id count once.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import lower_ascii, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_WINDOWS = 1_000_000
MAX_BITS = 1 << 22


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(gram, length, items): each distinct window and the ids that hold it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    grams = items.select("item", "length", F.explode(
        F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.col("length")), " "))).alias("gram"))
    return grams.groupBy("gram", "length").agg(F.collect_set("item").alias("items"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _place(hashes: Column, bits: int) -> Column:
    """A window's bit, from the hashes of its words."""
    return F.xxhash64(hashes).bitwiseAND(F.lit(bits - 1))


def _screen(grams: DataFrame, count: int) -> tuple[Column, int]:
    """Bit array over the grams' hashes as a constant, and its size in bits."""
    bits = min(MAX_BITS, max(1 << 12, 1 << math.ceil(math.log2(64 * max(count, 1)))))
    places = grams.select(_place(_hashes(F.split("gram", " ")), bits).alias("at"))
    filled = (places.groupBy(F.shiftright("at", 6).alias("slot"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).collect())   # <= bits / 64 rows
    slots = [0] * (bits // 64)
    for r in filled:
        slots[r["slot"]] = r["bits"]
    return F.from_json(F.lit(json.dumps(slots)), "array<bigint>"), bits


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text"
         ) -> DataFrame:
    """(doc_id, text_hash, n_words, positions, items) per distinct document:
    ``positions`` are the hit words' places from 1, ``items`` the sorted ids."""
    grams = stored(windows(benchmark, window), "windows")
    sizes = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        words_of(F.col(text_col)).alias("words"))
    screen, bits = _screen(grams, total)
    words = words.withColumn("screen", screen)

    def maybe(v, length):
        def gram(i):
            return F.array_join(F.slice(v["words"], i, F.lit(length)), " ")

        def bit(at):
            return F.getbit(F.get(v["screen"], F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1

        def test(i):
            return F.exists(F.array(_place(F.slice(v["hashes"], i, F.lit(length)), bits)), bit)

        last = F.size(v["words"]) - length + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(starts, test), lambda i: F.struct(
            i.alias("at"), F.lit(length).alias("length"), gram(i).alias("gram")))

    # A lambda's variable is worked out once; a column could be put into the
    # window's expression and be worked out for every window.
    once = F.array(F.struct("words", _hashes(F.col("words")).alias("hashes"), F.col("screen")))
    found = F.transform(once, lambda v: F.concat(*[maybe(v, n) for n in sorted(sizes)])) if sizes else None
    none = F.array().cast("array<struct<at:int,length:int,gram:string>>")
    scanned = stored(words.select("doc_id", "text_hash", F.size("words").alias("n_words"),
                                  (F.element_at(found, 1) if sizes else none).alias("found")), "scanned")
    grams = F.broadcast(grams) if total <= BROADCAST_WINDOWS else grams
    exact = (scanned.select("doc_id", "text_hash", F.explode("found").alias("f"))
             .select("doc_id", "text_hash", "f.at", "f.length", "f.gram").join(grams, ["gram", "length"]))
    per_doc = exact.groupBy("doc_id", "text_hash").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1))))
        .alias("positions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    right = stored(per_doc, "hits").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "positions",
                                           "items")
    left = scanned.select("doc_id", "text_hash", "n_words")
    return (left.join(right, left["doc_id"].eqNullSafe(right["_id"]) & (left["text_hash"] == right["_hash"]), "left")
            .drop("_id", "_hash"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """Per document row: word, hit and item counts, and the verdict: hit words
    are at least one in ``share``."""
    found = hits(docs, benchmark, window)
    n_hit = F.coalesce(F.size("positions"), F.lit(0)).cast("long")
    n_hit = F.when(F.col("positions").isNull(), F.lit(0).cast("long")).otherwise(n_hit)
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), "text_hash", "positions")


def _matched(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` as (row, _text) joined to ``found`` (doc_id, text_hash, ...)."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                       F.xxhash64("text").alias("_hash"))
    return rows.join(found, rows["_id"].eqNullSafe(found["doc_id"]) & (rows["_hash"] == found["text_hash"]), how)


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated ones; all else unchanged."""
    bad = report(docs, benchmark, window, share).where("contaminated").select("doc_id", "text_hash").distinct()
    return _matched(docs, stored(bad, "contaminated"), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """``docs`` with every hit word taken out of its text, together with what
    stands between two hit words."""
    found = hits(docs, benchmark, window).where("positions IS NOT NULL")
    found = stored(found.select("doc_id", "text_hash", "positions").distinct(), "spans")
    any_case = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    rows = _matched(docs, found, "left").select(
        "row", "positions", "_text", F.regexp_extract_all("_text", F.lit(any_case), F.lit(0)).alias("_words"),
        F.split("_text", any_case, -1).alias("_gaps"))
    rows = rows.withColumn("_hit", F.transform("_words", lambda w, i: F.array_contains("positions", i + 1)))

    def piece(i):
        before = F.when((i > 0) & F.get("_hit", i) & F.get("_hit", i - 1), F.lit("")).otherwise(F.get("_gaps", i))
        return F.concat(before, F.when(F.get("_hit", i), F.lit("")).otherwise(F.get("_words", i)))

    body = F.array_join(F.transform(F.sequence(F.lit(0), F.size("_words") - 1), piece), "")
    rest = F.concat(body, F.element_at("_gaps", -1))
    text = F.when(F.col("positions").isNotNull(), rest).otherwise(F.col("_text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns])

"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewarden.llm import arc_to_warc, boosted_quality, bpe_automaton, compression_bands
from slicewarden.llm import decontaminate, external_shuffle, lattice_dedup, license_scan, merkle_manifest
from slicewarden.llm import secret_scan, simhash_dedup, surrogates, token_alignment
from slicewarden.llm.common import read_table
from slicewarden.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Stands in for the secret a deployment passes to ``pseudonymise``.
SURROGATE_KEY = b"slicewarden surrogate key"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_bpe_path() -> str:
    return tokenizer_path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return f(spark, sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return run

    return register


@query("op1_quality")
def op1(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = boosted_quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = boosted_quality.score(docs, model)
    return scored.select("doc_id", boosted_quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op2_arc_to_warc", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
""")
def op2(spark, sf_dir):
    _, warc = arc_to_warc.archive_pages(read_table(spark, sf_dir, "pages"))
    return arc_to_warc.read_warc(spark, warc, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


@query("op3_compression_bands")
def op3(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression_bands.quality_rules(docs).drop("text")


@query("op4_bpe_automaton")
def op4(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe_automaton.encode(docs, word_bpe_path())
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op5_external_shuffle")
def op5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = external_shuffle.shards(docs, 24)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op7_secret_scan")
def op7(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = secret_scan.scan(docs, secret_scan.cutoffs(docs))
    base = F.filter("found", lambda s: s["kind"] < 3)

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return done.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
                       secret_scan.spans_text(F.col("found")).alias("spans"))


@query("op8_simhash_dedup")
def op8(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return simhash_dedup.simhash_components(docs).select("doc_id", "fingerprint", "component_id")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op10_decontaminate", rf"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item, least(13, len(w)) AS l, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS gram
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM docs, (SELECT DISTINCT l FROM windows))),
hits AS (
  SELECT p.r, p.i, p.l, w.item FROM places p JOIN windows w ON p.gram = w.gram AND p.l = w.l),
covered AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(i, i + l)) AS place FROM (SELECT DISTINCT r, i, l FROM hits)) GROUP BY r),
listed AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
  coalesce(t.n_items, 0)::BIGINT AS n_items, sha256(coalesce(t.names, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN covered c ON c.r = d.r LEFT JOIN listed t ON t.r = d.r
""")
def op10(spark, sf_dir):
    found = decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash", "positions")


@query("op6_surrogates")
def op6(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, SURROGATE_KEY)


@query("op9_license_scan")
def op9(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.license_scan(docs).drop("text")


_VALUE = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = " || ".join(f"({_VALUE.format(c)})" for c in ("doc_id", "source", "lang", "{n}", "text"))
# CRC-32 (its reversed polynomial is 3988292384) over the characters of a number's text.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295)"""


@query("op13_merkle_manifest", f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({_LEAF.format(n='n_chars')}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC32.format('doc_id')} % 7 = 0
      THEN sha256({_LEAF.format(n='(n_chars::HUGEINT + 1)')}) END AS tampered
  FROM documents),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM rows),
nodes(g, l, i, n, h) AS (
  SELECT g, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT g, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY g, l, i // 2, n),
subroots AS (SELECT g, l AS depth, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(l, i, n, h) AS (
  SELECT 0, g, n, h FROM subroots
  UNION ALL
  SELECT l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY l, i // 2, n),
steps AS (
  SELECT o.r, o.l, (v.i >> o.l) & 1 AS side, s.h
  FROM (SELECT DISTINCT e.r, p.l FROM leaves e JOIN nodes p ON p.g = e.g AND p.n > 1 AND p.i = 0) o
  JOIN leaves v ON v.r = o.r
  LEFT JOIN nodes s ON s.g = v.g AND s.l = o.l AND s.i = xor(v.i >> o.l, 1)
  UNION ALL
  SELECT v.r, 1000 + p.l, (v.g >> p.l) & 1, s.h
  FROM leaves v JOIN tops p ON p.n > 1 AND p.i = 0
  LEFT JOIN tops s ON s.l = p.l AND s.i = xor(v.g >> p.l, 1)),
proofs AS (
  SELECT r, string_agg(coalesce(h, ''), '' ORDER BY l) AS proof,
    list(CASE side WHEN 1 THEN 'L' ELSE 'R' END || coalesce(h, '') ORDER BY l) AS path FROM steps GROUP BY r),
folded AS (
  SELECT v.doc_id, v.leaf, u.h AS subroot, t.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(v.tampered, v.leaf), coalesce(p.path, [])),
      lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM leaves v JOIN subroots u ON u.g = v.g JOIN tops t ON t.n = 1 LEFT JOIN proofs p ON p.r = v.r)
SELECT *, folded_root = root AS verified FROM folded
""")
def op13(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    changed = merkle_manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle_manifest.manifest(docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"],
                                     keep={"tampered": F.when(hit, changed)})
    back = merkle_manifest.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2(merkle_manifest.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                        back.alias("folded_root"), (back == F.col("root")).alias("verified"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    found = token_alignment.align(docs, ("byte_bpe", tokenizer_path("byte_bpe_50k.json")),
                                  ("pieces", tokenizer_path("piece_bpe_32k.model")), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query("op11_lattice_dedup")
def op11(spark, sf_dir):
    return lattice_dedup.vector_links(read_table(spark, sf_dir, "embeddings"))

import random

import xxhash

from slicewarden.llm import simhash_dedup as sh


def plain_fingerprint(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [words] if len(words) < shingle else [words[i:i + shingle] for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits):
    """prints: list of (id, fingerprint); all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= max_bits:
                root[find(i)] = find(j)
    best = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            best[find(i)] = min(best.get(find(i), doc), doc)
    return [best.get(find(i)) for i in range(len(prints))]


def texts():
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("alpha Beta gamma delta épsilon zeta eta Theta".split()) for _ in range(300))
            for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for t in base[:4]:
        for k in range(8):
            words = t.split()
            words[rnd.randrange(300)] = f"w{k}"
            rows.append((100 + len(rows), " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "two words"), (None, base[5]),
             (None, "lonely text here"), (5, base[5]), (906, base[5].replace(" ", "\n")), (907, "a b c d e"),
             (908, "x " * 40_000)]
    return rows


def test_fingerprints_and_components_match_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", sh.F.lit("clash"))
    for bits, dense in ((3, 1024), (3, 1), (0, 2)):
        got = sh.simhash_components(df, max_bits=bits, dense=dense).collect()
        prints = [(d, plain_fingerprint(t)) for d, t in rows]
        want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints, bits))]
        assert sorted(map(repr, ((r.doc_id, r.fingerprint, r.component_id) for r in got))) == sorted(map(repr, want))


def test_links_find_every_pair(spark):
    rnd = random.Random(9)
    fps = {rnd.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bits in (0, 1, 3, 4, 6):
        want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits}
        for dense in (1024, 1):
            got = [tuple(r) for r in sh.links(df, bits, dense).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_long_chain_is_one_component(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "x long, y long")
    got = {r.fp: r.root for r in sh.component_labels(pairs).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_keep_one_row_per_component(spark):
    rows = texts() + [(3, texts()[3][1])]          # a repeated row
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", sh.F.lit(1))
    kept = sh.keep_one(df)
    assert kept.columns == df.columns
    comp = {(r.doc_id, r.component_id) for r in sh.simhash_components(df).collect()}
    groups = {c for _, c in comp if c is not None}
    got = kept.select("doc_id").collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(groups)
    assert sum(r.doc_id is None for r in got) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sh.simhash_components(df).count() == 0 and sh.keep_one(df).count() == 0

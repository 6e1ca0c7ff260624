"""Per-document operators against plain versions: compression bands, BPE,
quality classifier, license scan."""

import hashlib
import pathlib
import random
import re
import struct
import textwrap
import zlib

import numpy as np
import pytest
import zstandard

from slicewarden.llm import boosted_quality as bq
from slicewarden.llm import bpe_automaton, compression_bands, license_scan, queries
from slicewarden.llm.common import read_table

from conftest import SF_MID, SF_SMALL

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a b c d e f g h " * 4000), (6, "é" * 30_000), (4, "one"),
       (None, "no id <|endoftext|>Ünï Ça x's 12"), (7, "line\nline\n \nline #*$%&|<>[]"), (8, "  x　 日本 ﬁ İ"),
       (9, " ".join(f"w{i % 37}" for i in range(900)))]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", bq.F.lit("clash")).withColumn(
        "ids", bq.F.lit(1)).withColumn("n_words", bq.F.lit(1)).withColumn("spans", bq.F.lit(1))


# -- compression bands -----------------------------------------------------------

def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    cover = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            cover |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed


def test_bands_base_counts_match_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("a b c d e f".split()) for _ in range(rnd.randint(0, 120)))) for i in range(80)]
    rows += [r for r in ODD if not r[1] or len(r[1]) < 20_000]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", bq.F.lit("clash"))
    got = compression_bands.quality_rules(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(r.text)


def test_bands_verdict(spark):
    rnd = random.Random(2)
    noise = " ".join("".join(chr(33 + rnd.randrange(94)) for _ in range(9)) for _ in range(600))
    same = "".join(f"Item {i % 10} of the list was checked and found in good order today by the team.\n" for i in range(90))
    mixed = [f"{rnd.choice('abcdefgh')}{i % 50}" for i in range(3000)]
    prose = read_table(spark, SF_SMALL, "documents").where("n_chars > 3000").first().text
    half = prose + "\n" + noise
    rows = [(1, noise), (2, prose), (3, same), (4, half), (5, " ".join(mixed))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in compression_bands.quality_rules(df).collect()}
    packer = zstandard.ZstdCompressor(level=3)
    for i, text in rows:
        assert got[i].ratio == pytest.approx(len(packer.compress(text.encode())) / len(text.encode()))
    assert not got[1].kept and got[2].kept and not got[3].kept
    assert not got[4].kept and got[4].max_chunk_ratio > compression_bands.Bands().chunk[1]


def test_bands_noise_in_every_band_and_at_odd_offsets(spark):
    rnd = random.Random(21)

    def noise(letters, n):
        return " ".join("".join(rnd.choice(letters) for _ in range(12)) for _ in range(n // 13 + 1))[:n]

    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    docs = read_table(spark, SF_MID, "documents").where("n_chars > 12000").limit(40).collect()
    packer, bands = zstandard.ZstdCompressor(level=3), compression_bands.Bands()

    def kept(text):
        return compression_bands.measure(text.encode(), bands, packer)[-1]

    prose = next(d.text for d in docs if kept(d.text))
    for n in (280, 300, 400, 512, 600, 1000, 1024, 1500, 2000, 3000, 4000, 8000, 20_000):
        assert not any(kept(noise(base64, n)) for _ in range(5)), n
        if n >= 800:
            assert not any(kept(noise("abcdefghijklmnopqrstuvwxyz", n)) for _ in range(5)), n
    for letters in (base64, "abcdefghijklmnopqrstuvwxyz"):
        for at in (0, 700, 2048, 3333, 6001, len(prose)):
            for n in (2000, 4096):
                assert not kept(prose[:at] + " " + noise(letters, n) + " " + prose[at:]), (at, n)
    # 20 words of 9 letters: the shortest noise that the base rule lets through here.
    assert not kept(" ".join("".join(rnd.choice(base64) for _ in range(9)) for _ in range(20)))


def test_repeat_words_other_windows():
    rnd = random.Random(3)
    for window in (2, 3, 5, 6, 8):
        words = [rnd.choice([b"a", b"b"]) for _ in range(60)]
        grams = [tuple(words[i:i + window]) for i in range(61 - window)]
        cover = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(i, i + window)}
        assert compression_bands.repeat_words(words, window) == len(cover)


# -- BPE -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.word_bpe_path())


def test_bpe_matches_library_on_documents(spark, library):
    for table in (read_table(spark, SF_SMALL, "documents"), odd(spark)):
        done = bpe_automaton.encode(table, queries.word_bpe_path())
        back = bpe_automaton.decode(done.withColumnRenamed("decoded", "first"), queries.word_bpe_path())
        rows = back.collect()
        assert len(rows) == table.count()
        for r in rows:
            want = library.encode(r.text or "", add_special_tokens=False).ids
            assert list(struct.unpack(f"<{r.n_tokens}I", bytes(r.ids))) == want
            assert r.first == r.decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_query_digests(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op4_bpe_automaton"](spark, SF_SMALL).collect()}
    for r in read_table(spark, SF_SMALL, "documents").limit(40).collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        g = got[r.doc_id]
        assert g.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_long_words(library):
    tokenizer = bpe_automaton.load(queries.word_bpe_path())
    rnd = random.Random(4)
    for text in ["a" * 3000, "ha" * 2000, "!" * 999, *["".join(rnd.choice("ethanoris") for _ in range(400)) for _ in range(60)]]:
        assert list(struct.unpack(f"<{len(tokenizer.encode(text.encode())) // 4}I", tokenizer.encode(text.encode()))) == \
            library.encode(text, add_special_tokens=False).ids


def merge_by_rank(word, merges, end):
    parts = list(word[:-1]) + [word[-1] + end]
    for a, b in merges:
        i = 0
        while i < len(parts) - 1:
            if (parts[i], parts[i + 1]) == (a, b):
                parts[i:i + 2] = [a + b]
            i += 1
    return parts


def test_automaton_on_random_merges():
    rnd = random.Random(5)
    for trial in range(40):
        end = rnd.choice(["", "</w>"])
        symbols = list("abc") + ([c + end for c in "abc"] if end else [])
        vocab, merges = {s: i for i, s in enumerate(symbols)}, []
        for _ in range(14):
            a, b = rnd.choice(list(vocab)), rnd.choice(list(vocab))
            if (end and a.endswith(end)) or a + b in vocab:
                continue
            vocab[a + b] = len(vocab)
            merges.append((a, b))
        automaton = bpe_automaton.Automaton(vocab, merges, end)
        names = {i: t for t, i in vocab.items()}
        for _ in range(200):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
            assert [names[i] for i in automaton.word(word)] == merge_by_rank(word, merges, end), (word, merges)


# -- quality classifier ------------------------------------------------------------

def walk(model, t, x):
    """One tree, one row, step by step."""
    at = 0
    while model["left"][t, at] != at:
        at = model["left"][t, at] + int(x[model["feature"][t, at]] > model["threshold"][t, at])
    return model["value"][t, at]


def test_trees_fit_and_flat_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5) | (x[:, 2] > 1.5)).astype(float)
    model = bq.fit(x[:2000], y[:2000])
    p = bq.predict(model, x[2000:])
    assert ((p >= 0.5) == (y[2000:] == 1)).mean() > 0.95
    for i in range(0, 1000, 97):
        total = float(model["base"]) + sum(walk(model, t, x[2000 + i]) for t in range(len(model["feature"])))
        assert p[i] == pytest.approx(1 / (1 + np.exp(-total)))


def test_degenerate_training():
    assert bq.predict(bq.fit(np.zeros((0, 2)), np.zeros(0)), np.zeros((3, 2))).tolist() == [0.5] * 3
    assert bq.predict(bq.fit(np.zeros((5, 2)), np.ones(5)), np.zeros((1, 2)))[0] > 0.99


def test_held_out_accuracy_and_folds(spark):
    scored = queries.QUERIES["op1_quality"](spark, SF_MID)
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_MID, "labels").collect()}
    rows = scored.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    test = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q in test if q], [s for s, q in test if not q]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97 and np.mean([(s >= 0.5) == q for s, q in test]) > 0.95


def test_held_out_labels_are_not_read(spark):
    docs, labels = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels")
    flipped = labels.withColumn("quality", bq.F.when(bq.held_out(bq.F.col("doc_id")), 1 - bq.F.col("quality"))
                                .otherwise(bq.F.col("quality")))
    a, b = bq.train(docs, labels), bq.train(docs, flipped.union(labels.where("false")))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_odd_texts_are_scored(spark):
    df = odd(spark)
    model = bq.train(df.withColumn("text", bq.F.col("text")), spark.createDataFrame([], "doc_id long, quality int"))
    got = bq.score(df, model).collect()
    assert len(got) == len(ODD) and all(r.score == 0.5 and r.predicted == 1 for r in got)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (5, 0), (5, 0), (6, 1)], "doc_id long, quality int")
    assert len(bq.score(df, bq.train(df, labels)).collect()) == len(ODD)


# -- license scan ------------------------------------------------------------------

def test_license_templates_and_changes(spark):
    texts = [t for _, t in license_scan.TEMPLATES]
    rows = [(i, f"Some prose.\n{t}\nMore prose follows here.") for i, t in enumerate(texts)]
    rows += [(100, "Licensed under the Apache License, Version 3.0."), (101, None), (102, ""),
             (103, "the license of poets is broad"), (104, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
             (105, "So it began. " * 30 + "Licensed under CC BY-NC 4.0. " + "And on it went. " * 30),
             (106, "# released   under THE mit license #"), (107, "word " * 30_000 + "\nReleased under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", bq.F.lit(1)).withColumn("r", bq.F.lit(2))
    got = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    assert len(got) == len(rows) and got[0].row == 1
    for i, (name, text) in enumerate(license_scan.TEMPLATES):
        assert got[i].licenses == name, (i, got[i])
        kind, a, b = got[i].spans.rsplit(":", 2)
        assert text.startswith(rows[i][1][int(a):int(b)][:20]) or text[:40] in rows[i][1]
    assert got[100].licenses == "" and got[100].n_blocks == 1 and got[103].licenses == ""
    assert got[101].n_blocks == 0 and got[102].licenses == ""
    assert got[104].licenses == "CC-BY-NC-4.0,MIT" and got[105].licenses == "CC-BY-NC-4.0"
    assert got[106].licenses == "MIT" and got[107].licenses == "MIT"


def test_license_lines_of_documents(spark):
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    rows = license_scan.license_scan(read_table(spark, SF_MID, "documents")).collect()
    for r in rows:
        assert r.licenses == ",".join(sorted({v for k, v in lines.items() if k in r.text})), r.text[:300]


def test_license_inside_long_lines_of_prose(spark):
    texts = [r.text for r in read_table(spark, SF_MID, "documents").where("n_chars > 400").limit(400).collect()]
    prose = " ".join(" ".join(t.split()) for t in texts if not re.search(license_scan.HINT, t))
    rnd, rows = random.Random(9), []
    for n in (1_000, 5_000, 50_000):
        for _, template in license_scan.TEMPLATES:
            for _ in range(6 if n < 50_000 else 1):
                at = rnd.randrange(len(prose) - n)
                line = prose[at:at + n]
                cut = line.index(" ", n // 2 - 50) + 1
                rows.append((len(rows), line[:cut] + template + " " + line[cut:]))
    names = [name for n in (6, 6, 1) for name, _ in license_scan.TEMPLATES for _ in range(n)]
    places = [r[1].index(t) for r, t in zip(rows, [t for n in (6, 6, 1) for _, t in license_scan.TEMPLATES for _ in range(n)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in license_scan.license_scan(df).collect():
        assert r.licenses == names[r.doc_id], r.doc_id
        assert int(r.spans.split(":")[1]) == places[r.doc_id]


def test_license_wrapped_with_comment_prefixes(spark):
    rows = []
    for prefix in ("", "# ", " * ", "// ", "-- ", "; ", "dnl ", "REM "):
        for _, template in license_scan.TEMPLATES:
            lines = "\n".join(prefix + line for line in textwrap.wrap(template, 72))
            rows.append((len(rows), f"Prose stands here.\n\n{lines}\n\nint main() {{\n}}\n"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in license_scan.license_scan(df).collect():
        assert r.licenses == license_scan.TEMPLATES[r.doc_id % len(license_scan.TEMPLATES)][0], rows[r.doc_id]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert compression_bands.quality_rules(none).count() == 0
    assert bpe_automaton.encode(none, queries.word_bpe_path()).count() == 0
    assert license_scan.license_scan(none).count() == 0
    model = bq.train(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert bq.score(none, model).count() == 0


def plain_wording(have, want):
    """Least cost and span of ``want`` in ``have`` by the textbook table, one
    cell at a time."""
    cost = license_scan._cost
    table = [(0, s) for s in range(len(have) + 1)]
    for word in want:
        row = [(table[0][0] + cost(word), table[0][1])]
        for k, other in enumerate(have, 1):
            ways = [(table[k][0] + cost(word), table[k][1]), (row[k - 1][0] + cost(other), row[k - 1][1])]
            ways += [table[k - 1]] if other == word else []
            row.append(min(ways))
        table = row
    end = min(range(len(table)), key=lambda k: (table[k], k))
    return table[end][0], table[end][1], end


def test_license_wording_matches_the_plain_table():
    rnd = random.Random(9)
    vocabulary = "the software is provided as mit bsd 2 3 notice copy not any".split()
    for _ in range(300):
        want = [rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 9))]
        have = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 14))]
        at = rnd.randrange(len(have) + 1)
        have[at:at] = [w for w in want if rnd.random() < 0.8]
        numbers = {w: k for k, w in enumerate(vocabulary)}
        got = license_scan.wording(np.array([numbers[w] for w in have], np.int64),
                                   np.array([license_scan._cost(w) for w in have], np.int64),
                                   [numbers[w] for w in want], [license_scan._cost(w) for w in want])
        assert got == plain_wording(have, want)


def test_compression_decides_which_licenses_are_found(monkeypatch):
    text = "Some words. " + license_scan.TEMPLATES[1][1] + " More words follow the license here."
    assert [f[0] for f in license_scan.scan_text(text)[1]] == ["MIT"]
    real = license_scan._packers
    constant = lambda data: b"x" * 50
    monkeypatch.setattr(license_scan, "_packers", lambda t, level: (constant, [constant] * len(t)))
    assert license_scan.scan_text(text)[1] == []                    # no template saves a byte
    # The one that saves the most is compared first and takes the words.
    two = (("short", "Permission is hereby granted, free of charge"), ("long", license_scan.TEMPLATES[1][1]))
    monkeypatch.setattr(license_scan, "_packers", lambda t, level: (constant, [lambda d: b"x" * 10, lambda d: b"x" * 40]))
    assert license_scan.scan_text(text, two)[1][0][0] == "short"
    monkeypatch.setattr(license_scan, "_packers", real)
    assert [f[0] for f in license_scan.scan_text(text, two)[1]] == ["long"]


def test_whole_license_bodies_as_templates(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    names = [n for n in ("Apache-2.0", "GPL-2", "MPL-2.0", "BSD") if (folder / n).exists()]
    if not names:
        pytest.skip("no license texts on this machine")
    templates = tuple((n, (folder / n).read_text()) for n in names)
    words = "plain prose about a license that nobody has ever read to its end ".split()
    rows = []
    for k, (n, body) in enumerate(templates):
        changed = body.split()
        for at in range(50, len(changed), 60):
            if changed[at].isalpha() and license_scan._cost(changed[at].lower()) == 1:
                changed[at] = "changed"
        rows.append((k, " ".join(words * 30) + "\n" + body.replace("\n", "\n * ") + "\n" + " ".join(words * 30)))
        rows.append((100 + k, " ".join(changed)))
    rows.append((999, " ".join(words * 300)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in license_scan.license_scan(df, templates=templates).collect()}
    assert got == {k + more: n for more in (0, 100) for k, n in enumerate(names)} | {999: ""}


def plain_verdict(text, bands):
    """The bands' verdict, limit by limit, with fresh compressors."""
    def share(part):
        return len(zstandard.ZstdCompressor(level=bands.level).compress(part)) / len(part)

    data = text.encode()
    if not data:
        return True
    below = [w for w in bands.whole if w[0] <= len(data)][-1]
    above = next((w for w in bands.whole if w[0] > len(data)), None)
    high = below[2]
    if above and below[0]:
        high += (above[2] - below[2]) * np.log(len(data) / below[0]) / np.log(above[0] / below[0])
    if not below[1] <= share(data) <= high + 1e-12:
        return False
    for size, step, least, most in bands.chunks:
        at = 0
        while len(data) > size and at < len(data):
            part = data[min(at, len(data) - size):][:size]
            if not least <= share(part) <= most:
                return False
            at += step
    return True


def test_verdicts_match_plain_code_and_real_texts_are_kept(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    real = [(k, p.read_text()) for k, p in enumerate(sorted(folder.glob("*")))] if folder.exists() else []
    docs = read_table(spark, SF_SMALL, "documents").where("n_chars < 60000").collect()
    rows = real + [(1000 + d.doc_id, d.text) for d in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in compression_bands.quality_rules(df).collect()}
    bands = compression_bands.Bands()
    for k, text in rows:
        assert got[k].kept == (not got[k].base_failed and plain_verdict(text or "", bands)), k
    assert all(got[k].kept for k, _ in real if not got[k].base_failed) and len(real) != 1

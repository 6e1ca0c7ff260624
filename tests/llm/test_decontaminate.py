import random
import re

from slicewarden.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    grams = {}
    for item, text in items:
        w = plain(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = plain(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                got = grams.get(tuple(w[i:i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), tuple(sorted(str(f) for f in found if f is not None)),
                    bool(hit) and 20 * len(hit) >= len(w), frozenset(hit)))
    return out


def tables():
    rnd = random.Random(5)
    voc = "the of Été straße alpha beta gamma delta epsilon zeta İd x1 42 ÀB".split()
    items = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.randint(13, 30)))) for i in range(20)]
    items += [(50, "Only four words here"), (51, "solo"), (52, None), (53, ""), (54, "... --"), (None, "no id item text"),
              (3, items[3][1]), (55, items[4][1])]
    docs = []
    for i in range(120):
        words = [rnd.choice(voc) for _ in range(rnd.randint(0, 200))]
        if i % 3 == 0:
            at = rnd.randint(0, len(words))
            part = items[rnd.randrange(20)][1].split()
            lo = rnd.randint(0, 5)
            words[at:at] = part[lo:lo + rnd.randint(9, 30)]
        if i % 7 == 0:
            words += ["ONLY", "four!words", "HERE"]
        docs.append((i, " ".join(words) + rnd.choice(["", ".", "\n"])))
    docs += [(500, None), (501, ""), (None, items[0][1]), (None, items[0][1]), (1, docs[1][1]), (502, "solo"),
             (503, (items[1][1] + " ") * 300 + "filler " * 5000), (504, items[2][1].replace(" ", ", ").upper())]
    return docs, items


def test_report_matches_brute_force(spark):
    docs, items = tables()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", dc.F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.report(d, b).collect()
    import hashlib
    want = [(doc, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), c)
            for doc, n, h, f, c, _ in brute(docs, items)]
    have = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got]
    assert sorted(map(repr, have)) == sorted(map(repr, want))


def test_without_broadcast(spark, monkeypatch):
    docs, items = tables()
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(dc, "MAX_BITS", 1 << 6)          # a full screen lets every window through
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.report(d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((repr(r.doc_id), r.n_hit) for r in got) == sorted((repr(b[0]), b[2]) for b in brute(docs, items))


def test_remove_documents_and_spans(spark):
    docs, items = tables()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_id", dc.F.lit(7))
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    kept = dc.remove_documents(d, b)
    assert kept.columns == d.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(w[0]) for w in want if not w[4])
    left = dc.remove_spans(d, b)
    got = sorted((repr(r.doc_id), plain(r.text)) for r in left.collect())
    assert got == sorted((repr(w[0]), [x for i, x in enumerate(plain(t)) if i not in w[5]])
                         for w, (_, t) in zip(want, docs))


def test_empty_tables(spark):
    docs, items = tables()
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    got = dc.report(spark.createDataFrame(docs, "doc_id long, text string"), no_items)
    assert got.where("n_hit > 0 or contaminated").count() == 0 and got.count() == len(docs)

import hashlib
import random
import re
import string

import pytest

from slicewarden.llm import secret_scan as ss
from slicewarden.llm.common import read_table

from conftest import SF_SMALL

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def plain_base(text):
    """The base kinds by the contract's wording: match first, drop after."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def rows():
    rnd = random.Random(4)
    parts = ["password", "PassWd=", "secret", "token", "API_KEY", "apikey", ":", " = ", "'", '"', "abc", "=", "x" * 7,
             "AKIA", "AKIA" + "A1" * 9, "0123456789abcdef" * 2, "deadbeef", "é", "😀", "\n", " ", "A" * 16, "-", "Z9" * 20]
    out = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))) for i in range(400)]
    out += [(1000, None), (1001, ""), (1002, "token=" + "q1" * 20_000), (1003, "😀 token: 'abcdef' é 😀"),
            (None, "secret=token: abcdef"), (1004, "token=ab " * 3000 + "0" * 24), (1000, "password==abcdefg")]
    return out


def test_base_spans_match_brute_force(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string").withColumn("_base", ss.F.lit("clash"))
    got = ss.scan(df, {}).select("doc_id", "text", "found").collect()
    assert len(got) == len(rows())
    for r in got:
        assert [(s.start, s.kind, s.stop) for s in r.found] == plain_base(r.text or ""), r.text


def test_base_of_documents(spark):
    df = read_table(spark, SF_SMALL, "documents")
    for r in ss.scan(df, {}).select("text", ss.spans_text(ss.F.col("found")).alias("s")).collect():
        assert r.s == ",".join(f"{ss.KINDS[k]}:{a}:{b}" for a, k, b in plain_base(r.text))


def plain_p(body, alphabet):
    """The battery's p-value written out."""
    from math import erfc, sqrt

    def tail(z):
        return erfc(z / sqrt(2)) / 2

    x, n, k = [alphabet.index(c) for c in body], len(body), len(alphabet)
    chi = sum((x.count(s) - n / k) ** 2 / (n / k) for s in range(k))
    p = [tail((chi - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n))]
    high = [2 * v >= k for v in x]
    runs, up = 1 + sum(a != b for a, b in zip(high, high[1:])), sum(high)
    mean = 2 * up * (n - up) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    p.append(2 * tail(abs(runs - mean) / sqrt(var)) if var > 0 else 0.0)
    m = sum(x) / n
    spread = sum((v - m) ** 2 for v in x)
    r = sum((a - m) * (b - m) for a, b in zip(x, x[1:])) / spread if spread else 0
    p.append(2 * tail(abs(r + 1 / n) * sqrt(n)) if spread > 0 else 0.0)
    return 1 - (1 - min(p)) ** 3


def test_battery_matches_plain_statistics(spark):
    rnd = random.Random(8)
    cases = []
    for name, _, alphabet in ss.ALPHABETS:
        for n in (20, 33, 64, 200):
            cases += [(name, "".join(rnd.choice(alphabet) for _ in range(n))), (name, (alphabet[:4] * n)[:n - 1] + alphabet[-1]),
                      (name, alphabet[0] * n)]
    df = spark.createDataFrame([(b,) for _, b in cases], "body string")
    got = {r.body: r.t for r in df.select("body", ss.battery(ss.F.col("body")).alias("t")).collect()}
    fits = {name: (re.compile(p), a) for name, p, a in ss.ALPHABETS}
    for _, body in cases:
        first = next(n for n, (p, _) in fits.items() if p.match(body))
        assert got[body].encoding == first
        assert got[body].p == pytest.approx(plain_p(body.upper() if first == "hex" else body, fits[first][1]), abs=1e-5)


def corpus():
    rnd = random.Random(2)
    keys = ["".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(150)]
    words = [f"section-{i}-of-the-annual-report-{i % 7}" for i in range(150)]
    words += ["zzzz1111" * 5 + "y" * (i % 3) for i in range(60)]
    return keys, words


def test_battery_adds_random_keys_and_leaves_words(spark):
    keys, words = corpus()
    rows = [(i, f"see {w} here") for i, w in enumerate(keys + words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    limits = ss.cutoffs(df)
    found = {r.doc_id for r in ss.scan(df, limits).where("size(found) > 0").collect()}
    hit = sum(i in found for i in range(150))
    wrong = sum(i in found for i in range(150, len(rows)))
    assert hit >= 120 and wrong <= 0.1 * len(found)


def test_secrets_in_assignments_queries_and_paths(spark):
    rnd = random.Random(12)

    def key(n):
        return "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n))

    frames = ("auth={}", "sig={}", "session_id={}", "/live_key/{}", "https://x.org/a_b/c?sig={}&page_no=2",
              "/v1/live_key/{}/items_of_2019", "sk_live_{}", "0123456789abcdef01234567/{}")
    rows, places = [], []
    for i in range(320):
        text = f"see {frames[i % len(frames)]} here"
        value = key(40)
        places.append((text.index("{}"), text.index("{}") + 40))
        rows.append((i, text.format(value)))
    rows += [(1000 + i, f"see name={'zzzz1111' * 5}{'y' * (i % 3)} here") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    limits = ss.cutoffs(df)
    covered = dict.fromkeys(range(len(frames)), 0)
    for r in ss.scan(df, limits).collect():
        spans = [(s.start, s.stop) for s in r.found if s.kind == 3]
        if r.doc_id >= 1000:
            assert not spans
        else:
            a, b = places[r.doc_id]
            covered[r.doc_id % len(frames)] += any(x <= a and b <= y for x, y in spans)
    assert all(n >= 34 for n in covered.values()), covered      # of 40
    assert sum(r.text.count("[SECRET]") > 0 for r in ss.redact(df, limits).collect()) >= 280


def test_recall_of_each_encoding_and_length(spark):
    """Random keys of every encoding pass beside repetitive strings of the same band."""
    rnd, rows, of = random.Random(14), [], {}
    names = [a[0] for a in ss.ALPHABETS]
    tails = {"base32": "ZZ2", "base32lower": "zz2", "base36": "Z19", "base36lower": "z19", "alnum": "zZ1"}
    for name, alphabet in (("base32", string.ascii_uppercase + "234567"), ("base32lower", string.ascii_lowercase + "234567"),
                           ("base36", string.digits + string.ascii_uppercase),
                           ("base36lower", string.digits + string.ascii_lowercase),
                           ("alnum", string.digits + string.ascii_letters)):
        assert name in names
        for n in (24, 32, 40, 64):
            for i in range(900):
                of[len(rows)] = (name, n, i < 600)
                value = "".join(rnd.choice(alphabet) for _ in range(n)) if i < 600 else \
                    (("".join(rnd.sample(alphabet, 2)) + tails[name]) * n)[:n]
                rows.append((len(rows), f"see {value} here"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hit, wrong = {}, 0
    for r in ss.scan(df, ss.cutoffs(df)).where("exists(found, s -> s.kind = 3)").collect():
        name, n, random_key = of[r.doc_id]
        hit[name, n] = hit.get((name, n), 0) + random_key
        wrong += not random_key
    assert len(hit) == 20 and all(v >= 450 for v in hit.values()) and wrong <= 0.1 * sum(hit.values()), (hit, wrong)


def test_random_spans_hold_no_smaller_ones(spark):
    rnd = random.Random(13)
    alphabet = ss.ALPHABETS[[a[0] for a in ss.ALPHABETS].index("base64")][2]
    rows = [(i, "key " + "".join(rnd.choice(alphabet) for _ in range(120)) + "==") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole, limits = 0, {f"{name}:{band}": 0.05 for name, _, _ in ss.ALPHABETS for band in ss.BANDS}
    for r in ss.scan(df, limits).collect():
        spans = [(s.start, s.stop) for s in r.found if s.kind == 3]
        assert not any(a != b and a[0] <= b[0] and b[1] <= a[1] for a in spans for b in spans)
        whole += (4, 126) in spans
    assert whole >= 85


def test_redact_and_row_count(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string").withColumn("found", ss.F.lit(1))
    out = ss.redact(df, {})
    assert out.columns == df.columns
    by_text = {}
    for r in ss.scan(df, {}).select("doc_id", "text").collect():
        by_text.setdefault(r.doc_id, []).append(r.text)
    got = out.collect()
    assert len(got) == len(rows())
    want = []
    for doc, text in rows():
        out_text, at = "", 0
        if text is None:
            want.append((doc, None))
            continue
        for a, _, b in plain_base(text):
            if a > at or at == 0:
                out_text += text[at:a] + "[SECRET]"
            at = max(at, b)
        want.append((doc, out_text + text[at:]))
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ss.cutoffs(df) == {} and ss.scan(df, {}).count() == 0
    assert hashlib.sha256(b"").hexdigest()

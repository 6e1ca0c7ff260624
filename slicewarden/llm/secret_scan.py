"""Secret scan: base patterns and a randomness test battery, native.

Base kinds (``assign``, ``access``, ``hex``) are found by fixed patterns.  The
battery looks at runs of 20 or more key characters.  A run is cut at ``=`` and
at the symbols foreign to each of base64, URL-safe base64 and plain letters and
digits; every part of 20 or more characters that mixes letters and digits and
lies apart from the base spans is judged, the uncut run among them where it
fits.  The battery infers an encoding (hex, base32 and base36 of either case,
letters and digits, base64, URL-safe base64) and tests whether the symbols look
drawn uniformly:

* chi-squared uniformity of the symbol counts over the alphabet,
* runs above and below the alphabet's middle,
* serial correlation of neighbouring symbols.

The smallest of the three p-values m counts as 1 - (1 - m)^3, which is uniform
for a random string when the tests are independent.  Which p-values
pass is decided per encoding and length band over the whole corpus: for a
random string p is uniform, so the count above one half tells how many random
strings the band holds; the surplus above a cutoff is false discoveries, and
the band's cutoff is the least one with a false-discovery share of at most
``fdr``.  Longer bands separate better and get lower cutoffs by themselves.

Spans count code points, the end exclusive; an ``assign`` span is the whole
match.  A random span inside a longer random span is left out.  Defined cases: a null or empty text has no spans; equal starts are
ordered by kind (assign, access, hex, random); a band without any likely
random string lets nothing pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is long enough is the leftmost match of the bounded pattern too.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
RUN = "[A-Za-z0-9+/_=-]{20,}"
# Parts of a run, padding at its end included.
PARTS = ("[A-Za-z0-9+/]{20,}(?:=+$)?", "[A-Za-z0-9_-]{20,}(?:=+$)?", "[A-Za-z0-9]{20,}(?:=+$)?")
ALPHABETS = (
    ("hex", "^(?:[0-9A-F]+|[0-9a-f]+)$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base32lower", "^[a-z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", "^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36lower", "^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("alnum", "^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
BANDS = (20, 24, 32, 48, 64, 128)
BINS = 20
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _no(kind: str = SPAN) -> Column:
    return F.array().cast(kind)


def matches(text: Column, pattern: str) -> Column:
    """(start, stop, match) of the leftmost non-overlapping matches: what lies
    between them gives their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))
    zero = F.struct(F.lit(0).alias("at"), _no("array<struct<start:int,stop:int,hit:string>>").alias("out"))

    def add(acc, p):
        start = acc["at"] + F.char_length(p["gap"])
        stop = start + F.char_length(p["hit"])
        return F.struct(F.coalesce(stop, start).alias("at"), F.when(p["hit"].isNull(), acc["out"]).otherwise(
            F.array_append(acc["out"], F.struct(start.alias("start"), stop.alias("stop"), p["hit"].alias("hit"))))
            .alias("out"))

    return F.aggregate(pairs, zero, add, lambda acc: acc["out"])


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                 m["stop"].alias("stop")))


def base_spans(text: Column) -> Column:
    """All base spans, unsorted; the patterns run only on texts that can match."""
    low = F.lower(text)
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")
    any_word = F.contains(low, F.lit(words[0]))
    for w in words[1:]:
        any_word = any_word | F.contains(low, F.lit(w))
    assign = F.filter(matches(text, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= 6)
    return F.concat(
        F.when(any_word, _spans(assign, "assign")).otherwise(_no()),
        F.when(F.contains(text, F.lit("AKIA")), _spans(matches(text, ACCESS), "access")).otherwise(_no()),
        F.when(text.rlike("[0-9a-f]{24}"), _spans(matches(text, HEX), "hex")).otherwise(_no()))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _tail(z: Column) -> Column:
    """Upper normal tail (Abramowitz and Stegun 26.2.17)."""
    def above(x):
        return _let(1 / (1 + 0.2316419 * x), lambda t: F.exp(-x * x / 2) / 2.5066282746310002 * t * (
            0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))))

    return F.when(z < 0, 1 - above(F.greatest(z, F.lit(-38.0)) * -1)).otherwise(above(F.least(z, F.lit(38.0))))


def _chi(v: Column) -> Column:
    """P-value of the symbol counts; v has places, n and k."""
    zero = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("squares"))

    def count(acc, x):      # over sorted places: sum over symbols of count squared
        run = F.when(x == acc["last"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), (acc["squares"] + 2 * run - 1).alias("squares"))

    squares = F.aggregate(F.array_sort(v["places"]), zero, count, lambda a: a["squares"])
    chi = squares * v["k"] / v["n"] - v["n"]
    spread = F.sqrt(2 * (v["k"] - 1) * (v["n"] - 1) / v["n"])
    return _let((chi - (v["k"] - 1)) / spread, _tail)


def _order(v: Column) -> Column:
    """Smaller p-value of runs and serial correlation, in one pass."""
    k, n = v["k"], v["n"]
    zero = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("runs"), F.lit(0).alias("high"),
                    F.lit(0.0).alias("s"), F.lit(0.0).alias("s2"), F.lit(0.0).alias("pairs"))

    def follow(acc, x):
        high = F.when(2 * x >= k, F.lit(1)).otherwise(F.lit(0))
        before = F.when(2 * acc["last"] >= k, F.lit(1)).otherwise(F.lit(0))
        new = F.when((acc["last"] < 0) | (high != before), F.lit(1)).otherwise(F.lit(0))
        d = x.cast("double")
        near = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(d * acc["last"])
        return F.struct(x.alias("last"), (acc["runs"] + new).alias("runs"), (acc["high"] + high).alias("high"),
                        (acc["s"] + d).alias("s"), (acc["s2"] + d * d).alias("s2"), (acc["pairs"] + near).alias("pairs"))

    def sums(a):
        up = a["high"].cast("double")
        center = a["s"] / n
        ends = F.element_at(v["places"], 1) + F.element_at(v["places"], -1)
        return F.struct(a["runs"].alias("runs"), (2 * up * (n - up) / n + 1).alias("mean"),
                        (a["s2"] - n * center * center).alias("spread"),
                        (a["pairs"] - center * (2 * a["s"] - ends) + (n - 1) * center * center).alias("both"))

    def tests(t):
        var = (t["mean"] - 1) * (t["mean"] - 2) / (n - 1)
        runs = F.when(var <= 0, F.lit(0.0)).otherwise(
            2 * _let(F.abs(t["runs"] - t["mean"]) / F.sqrt(F.abs(var)), _tail))
        serial = F.when(t["spread"] <= 0, F.lit(0.0)).otherwise(
            2 * _let(F.abs(F.try_divide(t["both"], t["spread"]) + 1 / n) * F.sqrt(n), _tail))
        return F.least(runs, serial)

    return _let(F.aggregate(v["places"], zero, follow, sums), tests)


def battery(body: Column) -> Column:
    """(encoding, band, p) of a key-like string; null encoding if none fits."""
    which = F.lit(None).cast("int")
    for i, (_, pattern, _) in reversed(list(enumerate(ALPHABETS))):
        which = F.when(body.rlike(pattern), F.lit(i)).otherwise(which)
    names = F.array(*[F.lit(a[0]) for a in ALPHABETS])
    alphabets = F.array(*[F.lit(a[2]) for a in ALPHABETS])

    def spelled(w):
        letters = F.get(alphabets, w)
        symbols = F.when(w == 0, F.upper(body)).otherwise(body)
        return F.struct(w.alias("which"), F.char_length(letters).cast("double").alias("k"),
                        F.char_length(body).cast("double").alias("n"),
                        F.transform(F.split(symbols, ""), lambda c: F.instr(letters, c) - 1).alias("places"))

    def judged(v):
        band = F.lit(BANDS[0])
        for b in BANDS[1:]:
            band = F.when(v["n"] >= b, F.lit(b)).otherwise(band)
        p = _let(F.least(_chi(v), _order(v)), lambda m: F.least(F.lit(1.0), 1 - (1 - m) * (1 - m) * (1 - m)))
        return F.struct(F.get(names, v["which"]).alias("encoding"), band.alias("band"), p.alias("p"))

    none = F.struct(F.lit(None).cast("string").alias("encoding"), F.lit(BANDS[0]).alias("band"), F.lit(0.0).alias("p"))
    return _let(which, lambda w: F.when(w.isNull() | (F.char_length(body) < BANDS[0]), none).otherwise(
        _let(spelled(w), judged)))


def with_candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, _text, _base, _tested): the input row, its base spans, and the
    parts of runs apart from those that the battery can judge (start, stop, t)."""
    df = df.select(F.struct(*df.columns).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = df.withColumn("_base", base_spans(F.col("_text")))
    runs = F.filter(matches(F.col("_text"), RUN), lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]"))
    parts = F.flatten(F.transform(runs, lambda m: F.transform(
        F.array_distinct(F.concat(*[matches(m["hit"], p) for p in PARTS])),
        lambda s: F.struct((m["start"] + s["start"]).alias("start"), (m["start"] + s["stop"]).alias("stop"),
                           s["hit"].alias("hit")))))
    apart = F.filter(parts, lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]") & ~F.exists(
        "_base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    apart = F.when(F.col("_text").rlike(RUN.replace(",", "")), apart).otherwise(
        _no("array<struct<start:int,stop:int,hit:string>>"))
    df = df.withColumn("_runs", apart).withColumn("_tested", F.transform("_runs", lambda m: F.struct(
        m["start"].alias("start"), m["stop"].alias("stop"), battery(F.regexp_replace(m["hit"], "=+$", "")).alias("t"))))
    kept = F.filter("_tested", lambda m: m["t"]["encoding"].isNotNull())
    return df.withColumn("_tested", kept).drop("_runs")


def _outermost(spans: Column) -> Column:
    """Without the spans that lie inside another one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("last"), s.alias("s"))))
    zero = F.struct(F.lit(-1).alias("at"), _no().alias("out"))

    def add(acc, o):
        more = -o["last"] > acc["at"]
        return F.struct(F.greatest(acc["at"], -o["last"]).alias("at"),
                        F.when(more, F.array_append(acc["out"], o["s"])).otherwise(acc["out"]).alias("out"))

    return F.aggregate(ordered, zero, add, lambda a: a["out"])


def cutoffs(df: DataFrame, fdr: float = 0.05, text_col: str = "text") -> dict[str, float]:
    """Least passing p per "encoding:band", from all rows of ``df``.

    The histogram holds at most encodings x bands x ``BINS`` rows."""
    each = with_candidates(df.select(text_col), text_col).select(F.explode("_tested").alias("c")).select("c.t.*")
    cell = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")
    cells: dict[str, list[int]] = {}
    for r in each.groupBy("encoding", "band", cell.alias("bin")).count().collect():
        cells.setdefault(f"{r['encoding']}:{r['band']}", [0] * BINS)[r["bin"]] = r["count"]
    out = {}
    for name, counts in sorted(cells.items()):
        likely = 2 * sum(counts[BINS // 2:])
        for b in range(BINS):
            passing = sum(counts[b:])
            false = passing - min(passing, likely * (1 - b / BINS))
            if passing and likely and false <= fdr * passing:
                out[name] = b / BINS
                break
    return out


def scan(df: DataFrame, limits: dict[str, float], text_col: str = "text") -> DataFrame:
    """``df`` with ``found``: all spans as (start, kind, stop), in order; kind
    indexes ``KINDS``."""
    work = with_candidates(df, text_col)
    passed = _no()
    if limits:
        table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        ok = F.filter("_tested", lambda m: m["t"]["p"] >= F.try_element_at(
            table, F.concat_ws(":", m["t"]["encoding"], m["t"]["band"])))
        passed = _outermost(_spans(ok, "random"))
    return work.select(*[F.col(f"row.{c}").alias(c) for c in df.columns if c != "found"],
                       F.array_sort(F.concat("_base", passed)).alias("found"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def redact(df: DataFrame, limits: dict[str, float], mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``df`` with each stretch of spans in its text replaced by ``mark``."""
    work = scan(df.select(F.struct(*df.columns).alias("row"), F.col(text_col).alias("text")), limits, "text")
    text = F.col("text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        apart = (s["start"] > acc["at"]) | (acc["at"] == 0)
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.concat(acc["out"], between, F.when(apart, F.lit(mark)).otherwise(F.lit(""))).alias("out"))

    clean = F.aggregate("found", zero, add, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, 2147483647)))
    done = F.when(F.size("found") > 0, clean).otherwise(text)
    return work.select(*[done.alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in df.columns])

"""Personal data: keyed surrogates that keep type, format and identity.

Mail addresses, phone, card and social security numbers, IP addresses and
titled names are found by patterns; each text is then looked through again for
the family names, alone or after their given names, that a title showed in it.
Names that no title in the same text shows, and given names standing alone, are
not detected.  Every distinct entity of the corpus gets
one surrogate, drawn from an HMAC of the key, type, value and attempt: digits
for digits, letters for letters, the same separators, the card's brand digit
and check digit, a name of the same script with the gender of its title.

Distinct entities keep distinct surrogates, and no surrogate is a value that
occurs in the corpus: candidates that clash are drawn again with the next
attempt (the smallest value of a clash keeps its own).  Mentions of one entity
share its surrogate everywhere, also a family name with and without the given
name or title, or a phone number in two formats.  A given name after a title
without gender takes the gender that the same name has in its text, if any.

Defined cases: null texts stay null, texts without entities stay as they are;
repeated rows are treated alike; other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import bound_batches, stored

_TITLES = {"m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "г-н", "Κύριος"),
           "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "г-жа", "Κυρία"),
           "n": ("Dr", "Doctor", "Prof", "Professor", "Mx", "Rev", "Доктор", "Профессор", "Δρ", "Καθηγητής")}
_TITLE = "|".join(sorted((regex.escape(t) for ts in _TITLES.values() for t in ts), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAME = r"\p{Lu}(?:\p{L}|['’-](?!s(?!\p{L}))(?=\p{L}))+"
_H = "[0-9A-Fa-f]{1,4}"
ENTITY = regex.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    rf"|(?<![\w:.])(?=[0-9A-Fa-f]{{0,4}}:)(?P<ip6>(?:{_H}:){{7}}{_H}|(?:{_H}(?::{_H}){{0,6}})?::(?:{_H}(?::{_H}){{0,6}})?)(?![\w:]|\.\d)"
    rf"|(?<![\d.])(?P<ip>(?:{_OCTET}\.){{3}}{_OCTET})(?!\.?\d)"
    r"|(?<!\d)(?P<card>[2-6]\d{3}(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)"
    r"|(?<![\d-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?<![\d+])(?P<phone>\+\d{1,3}[ .-]?\d{1,3}(?:[ .-]\d{2}){3,5}(?!\d)|0\d(?:[ .-]\d{2}){4}(?!\d)|\+\d{8,15}(?!\d)"
    r"|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4})(?!\d)"
    rf"|(?<!\p{{L}})(?:(?:{_TITLE})\.?\p{{Zs}}+)++(?P<name>{_NAME}(?:\p{{Zs}}{_NAME})?)")
_CAPITAL = regex.compile(rf"(?<![\p{{L}}\p{{N}}_]){_NAME}(?![\p{{L}}\p{{N}}_])")
# A text without any of these holds no entity.
_FIRST = "".join(sorted({t[0] for ts in _TITLES.values() for t in ts}))
MAYBE = rf"[@0-9]|:[A-Fa-f]{{0,4}}:|(?=[{_FIRST}])(?:{_TITLE})"
# Sounds for invented names by script: consonants, vowels, endings by gender.
_SOUNDS = {
    "latin": ("bdfgklmnprstvz", "aeiou", {"f": "a", "m": "on", "n": "y", "": "er"}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"f": "а", "m": "ов", "n": "и", "": "ин"}),
    "greek": ("βγδζκλμνπρστ", "αειου", {"f": "α", "m": "ος", "n": "ι", "": "ης"}),
}


def script_of(word: str) -> str:
    c = word[:1]
    return "cyrillic" if "Ѐ" <= c <= "ԯ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _address6(raw: str) -> str | None:
    """The one spelling of an IPv6 address; None for other text with colons."""
    try:
        value = ipaddress.IPv6Address(raw).compressed
    except ValueError:
        return None
    return value if regex.search(r"\d", raw) or len(regex.findall(_H, raw)) > 3 else None


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, value): value is what names the entity, whatever the
    mention's format.  A name yields one unit per part."""
    out, names = [], []
    for m in ENTITY.finditer(text):
        kind = m.lastgroup
        start, end = m.span(kind)
        if kind != "name":
            raw = m[kind]
            digits = regex.sub(r"\D", "", raw)
            if kind == "card" and _luhn(digits[:-1]) != digits[-1]:
                continue                    # some other long number
            value = raw.lower() if kind == "email" else raw if kind == "ip" else digits
            if kind == "ip6":
                value = _address6(raw)
            if kind == "phone":
                value = digits[-10:] if len(digits) >= 10 else digits
            if value:
                out.append((start, end, kind, value))
            continue
        titles = regex.findall(_TITLE, text[m.start():start])
        gender = next((g for g in "mf" for t in titles if t in _TITLES[g]), "n")
        parts = [(p.start() + start, p.end() + start, p[0].lower()) for p in regex.finditer(r"\P{Zs}+", m["name"])]
        names.append((gender, parts))
    if not names:
        return out
    families, genders, taken = set(), {}, out[:]
    for gender, parts in names:
        families.add(parts[-1][2])
        if len(parts) > 1:
            pair = (parts[0][2], parts[1][2])
            genders[pair] = gender if genders.get(pair, "n") == "n" else genders[pair]

    def add(gender, parts):
        if len(parts) > 1:
            out.append((parts[0][0], parts[0][1], "given", f"{gender}:{parts[0][2]}"))
        out.append((parts[-1][0], parts[-1][1], "family", parts[-1][2]))

    for gender, parts in names:
        add(genders[parts[0][2], parts[1][2]] if gender == "n" and len(parts) > 1 else gender, parts)
        taken.append((parts[0][0], parts[-1][1]))
    # The same names again, without a title.
    covered = iter(sorted((t[0], t[1]) for t in taken))
    begin, stop = next(covered)
    before = None
    for m in _CAPITAL.finditer(text):
        while stop <= m.start():
            begin, stop = next(covered, (len(text) + 1, len(text) + 1))
        word = (m.start(), m.end(), m[0].lower())
        if m.end() > begin:                 # part of a mention that is known
            before = None
            continue
        if word[2] in families:
            full = before and text[before[1]:word[0]].isspace() and genders.get((before[2], word[2]))
            add(full, [before, word]) if full else add("", [word])
            before = None if full else word
        else:
            before = word
    return sorted(out)


class _Draw:
    """Endless keyed numbers for one (type, value, attempt)."""

    def __init__(self, key: bytes, *what):
        self.key, self.seed, self.n, self.pool = key, "\x00".join(map(str, what)).encode(), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 1 << 32:
            block = hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n, self.pool, self.left = self.n + 1, int.from_bytes(block, "big"), 1 << 256
        self.pool, got = divmod(self.pool, n)
        self.left //= n
        return got

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits, the rest kept."""
        return "".join(chr(97 + self.below(26)) if c.isalpha() else str(self.below(10)) if c.isdigit() else c for c in text)


def _luhn(digits: str) -> str:
    """Check digit of a card number without its last digit."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def propose(kind: str, value: str, attempt: int, key: bytes) -> str:
    """Candidate surrogate value; a longer one, or an address from a wider range,
    once many attempts clashed."""
    draw, more = _Draw(key, kind, value, attempt), attempt // 8
    if kind == "email":
        local, _, domain = value.partition("@")
        names, _, top = domain.rpartition(".")
        return draw.like(local) + draw.like("x" * more) + "@" + _Draw(key, "domain", domain).like(names) + "." + top
    if kind == "ip":
        o = [int(x) for x in value.split(".")]
        keep = 1 if o[0] == 10 else 2 if (o[0], o[1]) == (192, 168) or o[0] == 172 and 16 <= o[1] < 32 else 0
        if attempt >= 16:                   # whatever is left: reserved addresses for private ones
            keep, o = 1, [240 + draw.below(16) if keep else 1 + draw.below(223)]
        elif attempt >= 8 and keep == 2:    # its range may be full of real values
            keep, o = 1, [10]
        first = o[:keep] or [1 + draw.below(9) if o[0] < 10 else 11 + draw.below(89) if o[0] < 100 else 100 + draw.below(27)]
        return ".".join(map(str, [*first, *[draw.below(256) for _ in range(4 - len(first))]]))
    if kind == "ip6":
        groups = value.split(":")
        if attempt >= 8:
            groups = [groups[0] or "x"] + ["x"] * 7
        drawn = [g and f"{1 + draw.below(9)}{draw.below(4096):03x}" for g in groups]
        if groups[0][:2] in ("fc", "fd", "fe") and any(groups[1:]):
            drawn[0] = groups[0]            # private or of one link
        return ":".join(drawn)
    if kind == "card":
        brand = 2 if len(value) == 15 else 1
        body = value[:brand] + draw.like(value[brand:-1])
        return body + _luhn(body)
    if kind == "ssn":
        return "9" + draw.like(value[1:])
    if kind == "phone":
        if value[0] == "0":
            return "0" + str(1 + draw.below(9)) + draw.like(value[2:])
        return str(2 + draw.below(8)) + draw.like(value[1:])
    gender, _, word = value.rpartition(":")
    consonants, vowels, endings = _SOUNDS[script_of(word)]
    syllables = max(2, min(5, len(word) // 2 - 1)) + more
    stem = "".join(consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(syllables))
    return (f"{gender}:" if gender else "") + stem + consonants[draw.below(len(consonants))] + endings[gender]


def written(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("given", "family"):
        word = surrogate.rpartition(":")[2]
        return word.upper() if mention.isupper() else word[:1].upper() + word[1:]
    if kind == "email":
        return surrogate.upper() if mention.isupper() else surrogate
    if kind in ("ip", "ip6"):
        return surrogate
    places = [i for i, c in enumerate(mention) if c.isdigit()][-len(surrogate):]
    out = list(mention)
    for i, d in zip(places, surrogate):
        out[i] = d
    return "".join(out)


_UNITS = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))


def _mentions(df: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, value): distinct entities of each text."""
    @F.arrow_udf("array<struct<kind:string,value:string>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            units = [sorted({(k, v) for _, _, k, v in find(t)}) if t else [] for t in texts.to_pylist()]
            yield pa.array([[{"kind": k, "value": v} for k, v in u] for u in units], _UNITS)

    return df.select("doc_id", "text_hash", F.explode(run("text")).alias("u")).select("doc_id", "text_hash", "u.*")


def mapping(entities: DataFrame, key: bytes, rounds: int = 200) -> DataFrame:
    """(kind, value, surrogate) of the distinct (kind, value) rows given."""
    bound_batches(entities.sparkSession, 5000)

    @F.arrow_udf("string")
    def run(kind: pa.Array, value: pa.Array, attempt: pa.Array) -> pa.Array:
        return pa.array([propose(k, v, a, key) for k, v, a in
                         zip(kind.to_pylist(), value.to_pylist(), attempt.to_pylist())], pa.string())

    real = entities.select("kind", F.col("value").alias("surrogate"))
    pending, done = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(rounds):
        drawn = stored(pending.withColumn("surrogate", run("kind", "value", "attempt")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        free = first.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stored(free.select("kind", "value", "surrogate"), "won")
        done = won if done is None else stored(done.unionByName(won), "surrogates")
        pending = stored(drawn.join(won, ["kind", "value"], "left_anti")
                         .select("kind", "value", (F.col("attempt") + 1).alias("attempt")), "pending")
        if pending.limit(1).count() == 0:
            return done
    raise RuntimeError(f"entities without a free surrogate after {rounds} attempts")


def pseudonymise(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with surrogates in its texts, ``n_entities`` (mentions) and
    ``entities`` ("type:start:end" in the text as it was, comma-joined)."""
    bound_batches(df.sparkSession)
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                     F.xxhash64(text_col).alias("text_hash"))
    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    units = stored(_mentions(rows.where(maybe).select("doc_id", "text_hash", "text")).distinct(), "mentions")
    chosen = mapping(stored(units.select("kind", "value").distinct(), "entities"), key)
    bound_batches(df.sparkSession)
    per_text = stored(units.join(chosen, ["kind", "value"]).groupBy("doc_id", "text_hash")
                      .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("units")), "per_text")
    per_text = per_text.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "units")
    out_type = pa.struct([("text", pa.string()), ("n", pa.int64()), ("spans", pa.string())])

    @F.arrow_udf("struct<text:string,n:long,spans:string>")
    def run(texts: pa.Array, units: pa.Array) -> pa.Array:
        out = []
        for text, known in zip(texts.to_pylist(), units.to_pylist()):
            if not known:
                out.append({"text": text, "n": 0, "spans": ""})
                continue
            table = {(u["kind"], u["value"]): u["surrogate"] for u in known}
            parts, at, spans = [], 0, []
            for start, end, kind, value in find(text):
                parts += [text[at:start], written(kind, text[start:end], table[kind, value])]
                spans.append(f"{kind}:{start}:{end}")
                at = end
            out.append({"text": "".join(parts) + text[at:], "n": len(spans), "spans": ",".join(spans)})
        return pa.array(out, out_type)

    # Only texts that can hold an entity are moved.
    held = rows.where(maybe)
    held = held.join(per_text, held["doc_id"].eqNullSafe(per_text["_id"]) & (held["text_hash"] == per_text["_hash"]),
                     "left").select("row", run("text", "units").alias("r"))
    none = F.struct(F.col("text"), F.lit(0).cast("long").alias("n"), F.lit("").alias("spans"))
    both = held.unionByName(rows.where(~maybe).select("row", none.alias("r")))
    names = ("n_entities", "entities")
    return both.select(*[F.col("r.text").alias(c) if c == text_col else F.col(f"row.{c}").alias(c)
                         for c in df.columns if c not in names],
                       F.col("r.n").alias("n_entities"), F.col("r.spans").alias("entities"))

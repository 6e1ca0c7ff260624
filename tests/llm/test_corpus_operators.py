"""Shuffle, archive and surrogate operators, and the pipeline."""

import collections
import gzip
import io
import random

import pytest

import corpus_pipeline
from slicewarden.llm import arc_to_warc as aw
from slicewarden.llm import decontaminate, external_shuffle, queries, secret_scan, simhash_dedup, surrogates
from slicewarden.llm.common import read_table, shared_path

from conftest import SF_SMALL

F = external_shuffle.F


# -- shards ------------------------------------------------------------------------

def check_law(rows, count, n):
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    sizes = [len(by_shard[s]) for s in range(count)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(by_shard) <= set(range(count))
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_shards_hold_every_row_once(spark):
    rnd = random.Random(1)
    rows = [(i if i % 9 else None, rnd.choice([None, "", "same text", f"t{i}"])) for i in range(1000)] + [(5, "same text")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn("slot", F.lit(0))
    for count, bucket_bytes in ((24, 1 << 25), (7, 500), (3, 64)):
        got = external_shuffle.shards(df, count, bucket_bytes=bucket_bytes).collect()
        check_law(got, count, len(rows))
        assert sorted(repr((r.row.doc_id, r.row.text)) for r in got) == sorted(map(repr, rows))


def test_shuffle_is_seeded_and_mixes(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))

    def order(seed):
        got = external_shuffle.shards(df, 8, seed=seed, bucket_bytes=20_000).collect()
        return [r.row.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]

    a, b, c = order(1), order(1), order(2)
    assert a == b and a != c and sorted(a) == list(range(4000))
    fixed = sum(x == i for i, x in enumerate(a))
    rising = sum(x < y for x, y in zip(a, a[1:]))
    assert fixed < 20 and 1800 < rising < 2200
    thirds = collections.Counter(x * 3 // 4000 for x in a[:1333])
    assert all(350 < v < 540 for v in thirds.values())


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    check_law(external_shuffle.shards(few, 24).collect(), 24, 2)
    assert external_shuffle.shards(few.where("doc_id > 9"), 24).count() == 0


def test_written_shards(spark):
    df = read_table(spark, SF_SMALL, "documents")
    path = shared_path(spark, "shards")
    external_shuffle.write_shards(df, path, 24)
    back = spark.read.parquet(path)
    assert back.count() == df.count() and set(back.columns) == {*df.columns, "shard", "slot"}
    check_law(back.select("shard", "slot").collect(), 24, df.count())


def test_query_rows(spark):
    import zlib

    got = queries.QUERIES["op5_external_shuffle"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    check_law(got, 24, len(texts))
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)


# -- archives ------------------------------------------------------------------------

PAGES = [(3, "http://a/ b", "x" * 200), (1, "http://c/", "x" * 200), (2, None, "x" * 200), (9, "http://d/", "x" * 99),
         (8, "http://e/", "x" * 99), (7, "", None), (6, "http://f/", ""), (None, "http://g/", "x" * 200), (2, "http://h/", "x" * 200),
         (11, "http://i/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n" * 9), (12, "http://j/", "http://x 1 2 t 5\n1 0 x\n" * 9 + "é😀\n\n"),
         (13, "http://k/", "long " * 300_000)]


def test_pages_round_trip_through_arc_and_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    for records in (20_000, 2):
        arc, warc = aw.archive_pages(pages, records)
        got = aw.read_warc(spark, warc).collect()
        assert sorted(repr((r.page_id, len(r.payload) if r.payload is not None else 0)) for r in got if r.type == "response")
        assert len(got) == len(PAGES) and len({r.record_id for r in got}) == len(PAGES)
        copies = [r for r in got if r.payload_bytes == 200]
        assert sorted((r.type, r.page_id if r.page_id is not None else -1) for r in copies)[0] == ("response", 1)
        assert [r.type for r in copies].count("revisit") == 4
        first = next(r for r in copies if r.type == "response")
        assert all(r.refers_to == 1 and r.refers_to_record == first.record_id for r in copies if r.type == "revisit")
        texts = {p: h or "" for p, _, h in PAGES}
        for r in got:
            if r.payload is not None and r.page_id is not None:
                assert bytes(r.payload).decode() == texts[r.page_id]
        assert {r.url for r in got} >= {"http://a/%20b", "-"}
        raw = aw.read_arc(spark, arc).collect()
        assert {r.size for r in raw} == {r.payload_bytes for r in got}


def test_both_versions_are_written_and_read(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for version in (1, 2):
        path = shared_path(spark, "arc")
        aw.write_arc(pages.repartition(2), path, versions=(version,))
        text = b"".join(gzip.decompress(bytes(r.content)) for r in
                        spark.read.format("binaryFile").load(path).collect())
        assert f"\n{version} 0 slicewarden\n{' '.join(aw.FIELDS[version])}\n".encode() in text
        assert aw.read_arc(spark, path).count() == len(PAGES)


def arc(body, version=1, name="t.arc"):
    return aw.version_block(name, version, "19990101000000") + b"\n" + body


def test_parse_arc_records_and_errors():
    doc = b"HTTP/1.0 404 Not Found\r\nServer: x\r\n\r\ngone"
    text = arc(b"http://a/ 1.2.3.4 19990102030405 text/html %d\n%s\ndns:a 1.2.3.4 199901 text/dns 3\nabc\n" % (len(doc), doc))
    rows = list(aw.parse_arc(io.BytesIO(text), "t.arc"))
    assert [(r[2], r[6], r[8], r[11]) for r in rows] == [("http://a/", 404, b"gone", None), ("dns:a", None, b"abc", None)]
    v2 = arc(b"http://a/ 1.2.3.4 19990102030405 text/html 301 - - 77 t.arc 5\nhello\n", 2)
    assert [(r[6], r[8]) for r in aw.parse_arc(io.BytesIO(v2), "t.arc")] == [(301, b"hello")]
    for bad in (arc(b"http://a/ 1.2.3.4 1999 text/html 9\nabc"), arc(b"http://a/ 1.2.3.4 1999 text/html x\nabc"),
                arc(b"http://a/ 1.2.3.4 1999 3\nabc"), b"http://a/ 1 2 3 3\nabc\n",
                arc(b"").replace(b"\n1 0", b"\n7 0"), arc(b"").replace(b"Archive-date", b"Archive-dato")):
        with pytest.raises(ValueError):
            list(aw.parse_arc(io.BytesIO(bad), "t.arc"))


def test_dates_and_record_kinds():
    assert aw.warc_date("19990102030405") == "1999-01-02T03:04:05Z" and aw.warc_date("1999") == "1999-01-01T00:00:00Z"
    assert aw.warc_date("") == aw.warc_date("19991399000000") == aw.warc_date("x") == "1970-01-01T00:00:00Z"
    row = {"head": b"", "payload": b"abc", "url": "ftp://x", "date": "1999", "archive": "a", "place": 0, "digest": "d",
           "ip": "-", "mime": "text/plain", "size": 3, "page_id": None, "first_place": None}
    assert b"WARC-Type: resource" in aw.warc_record(row)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    _, warc = aw.archive_pages(none)
    assert aw.read_warc(spark, warc).count() == 0


# -- surrogates ----------------------------------------------------------------------

KEY = b"k"
PEOPLE = [(1, "Mail Anna.Bell7@mail1.example.com or anna.bell7@MAIL1.example.com, call +1 (956) 555-0122."),
          (2, "call 956-555-0122 or 956.555.0123; card 4111 1111 1111 1111 and 4111111111111111"),
          (3, "Mrs. Maria Jones met Mr. Jones; Frau Müller; г-жа Иванова. MRS. x"), (4, None), (5, "no digits at all"),
          (6, "hosts 10.1.2.3, 192.168.0.7, 44.7.9.250, 999.1.1.1 and 1.2.3.4.5; ssn 123-45-6789"), (7, ""),
          (1, "Mail anna.bell7@mail1.example.com"), (None, "Mr. Jones"), (8, "word " * 30_000 + "bob@x.org")]


def test_surrogates_keep_identity_and_format(spark):
    df = spark.createDataFrame(PEOPLE, "doc_id long, text string").withColumn("entities", F.lit(1)).withColumn("units", F.lit(2))
    got = {(r.doc_id, i): r for i, r in enumerate(sorted(surrogates.pseudonymise(df, KEY).collect(),
                                                         key=lambda r: (r.doc_id or 0, -len(r.text or ""))))}
    assert len(got) == len(PEOPLE)
    text = {}
    for (d, _), r in got.items():
        text.setdefault(d, []).append(r.text)
    whole = " ".join(t or "" for ts in text.values() for t in ts)
    for secret in ("bell7", "555-0122", "956", "4111", "Jones", "Müller", "Иванова", "123-45", "44.7.9.250", "bob@"):
        assert secret.lower() not in whole.lower(), secret
    mails = [w.strip(",.") for w in text[1][0].split() if "@" in w]
    assert mails[0].lower() == mails[1].lower() == [w for w in text[1][1].split() if "@" in w][0].lower()
    assert "+1 (" in text[1][0]
    digits = "".join(c for c in text[1][0].split("call")[1] if c.isdigit())[1:]
    first, second = text[2][0].split(";")[0].split("call ")[1].split(" or ")
    assert first.replace("-", "") == digits and second.replace(".", "") != digits
    card = text[2][0].split("card ")[1].split(" and ")
    assert card[0].replace(" ", "") == card[1] and card[1][0] == "4" and surrogates._luhn(card[1][:-1]) == card[1][-1]
    names = text[3][0]
    family = names.split("met Mr. ")[1].split(";")[0]
    assert names.split()[2] == family and names.split()[1].endswith("a") and family in text[None][0]
    assert surrogates.script_of(names.split("г-жа ")[1].lower()) == "cyrillic"
    assert "999.1.1.1 and 1.2.3.4.5" in text[6][0] and text[6][0].split()[1].startswith("10.") and "192.168." in text[6][0]
    assert text[4] == [None] and text[5] == ["no digits at all"] and text[7] == [""]


def test_bare_later_mentions_share_the_surrogate(spark):
    text = ("Mr John Smith came. John Smith sat; then Smith said SMITH's dog slept, John\nSmith nodded. Smithson and smith "
            "stay. Prof. Dr. Weber left; Weber's hat. Dr Anna Bell is Mrs Anna Bell.")
    df = spark.createDataFrame([(1, text), (2, "Smith and Weber without a title")], "doc_id long, text string")
    got = {r.doc_id: r for r in surrogates.pseudonymise(df, KEY).collect()}
    out = got[1].text
    for real in ("John", "Smith ", "SMITH", "Smith said", "Weber", "Anna", "Bell"):
        assert real not in out.replace("Smithson", ""), (real, out)
    given, family = out.split()[1:3]
    assert out.startswith(f"Mr {given} {family} came. {given} {family} sat; then {family} said {family.upper()}'s dog slept, "
                          f"{given}\n{family} nodded. Smithson and smith stay. Prof. Dr. ")
    weber = out.split("Prof. Dr. ")[1].split()[0]
    assert f"left; {weber}'s hat" in out
    woman = out.split(". Dr ")[-1].split(" is Mrs ")
    assert woman[0] + "." == woman[1] and woman[0].split()[0].endswith("a")
    assert got[1].n_entities == 14 and got[2].n_entities == 0


def test_more_formats_of_numbers_and_addresses(spark):
    mentions = ["+15551234567", "+33 6 12 34 56 78", "06 12 34 56 78", "378282246310005", "3782 822463 10005",
                "2223003122003222", "2001:db8::8a2e:370:7334", "fe80::1", "2001:DB8:0:0:0:0:0:1", "2001:db8::1"]
    kinds = ["phone"] * 3 + ["card"] * 3 + ["ip6"] * 4
    df = spark.createDataFrame([(i, f"see {m} now") for i, m in enumerate(mentions)] +
                               [(99, "std::ab at 12:30:45 from aa:bb:cc:dd:ee:ff")], "doc_id long, text string")
    got = {r.doc_id: r for r in surrogates.pseudonymise(df, KEY).collect()}
    for i, (mention, kind) in enumerate(zip(mentions, kinds)):
        assert got[i].entities == f"{kind}:4:{4 + len(mention)}" and mention not in got[i].text
        assert [f[2] for f in surrogates.find(got[i].text)] == [kind], got[i].text
    assert got[3].text[4:-4] == got[4].text[4:-4].replace(" ", "") and got[8].text == got[9].text
    assert got[99].entities == "" and got[7].text.startswith("see fe80::")


def test_clashing_candidates_are_drawn_again(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "propose", lambda kind, value, attempt, key: str((int(value) // 3 + attempt * 7) % 500))
    ids = spark.createDataFrame([("phone", str(600 + i)) for i in range(60)] + [("phone", "3")], "kind string, value string")
    got = surrogates.mapping(ids, KEY).collect()
    assert len(got) == 61 == len({r.surrogate for r in got}) and not {r.surrogate for r in got} & {r.value for r in got}


def test_full_private_ranges_get_surrogates(spark):
    real = {f"192.168.{i // 256}.{i % 256}" for i in range(40_000)} | {f"172.20.{i}.1" for i in range(256)}
    ids = spark.createDataFrame([("ip", v) for v in sorted(real)], "kind string, value string").repartition(4)
    got = surrogates.mapping(ids, KEY, rounds=24).collect()
    assert {r.value for r in got} == real and len({r.surrogate for r in got}) == len(got) == len(real)
    assert not real & {r.surrogate for r in got}
    assert all(r.surrogate.startswith(("192.168.", "172.20.", "10.")) for r in got)
    for attempt in (0, 8, 16, 30):
        for v in ("10.1.2.3", "192.168.0.7", "44.7.9.250"):
            new = surrogates.propose("ip", v, attempt, KEY)
            assert [f[2:] for f in surrogates.find(new)] == [("ip", new)]


def test_surrogates_of_documents_are_distinct(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    table, back = {}, {}
    for r in surrogates.pseudonymise(docs, KEY).collect():
        old, new = surrogates.find(before[r.doc_id]), surrogates.find(r.text)
        assert r.n_entities == len(old) == len(new)
        for (_, _, k, v), (_, _, k2, v2) in zip(old, new):
            assert k == k2 and v != v2 and table.setdefault((k, v), v2) == v2 and back.setdefault((k, v2), v) == v


def test_surrogates_empty_table(spark):
    assert surrogates.pseudonymise(spark.createDataFrame([], "doc_id long, text string"), KEY).count() == 0


# -- pipeline --------------------------------------------------------------------------

def test_pipeline_stages(spark):
    sf = SF_SMALL
    docs = read_table(spark, sf, "documents")
    columns = docs.columns
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_dedup", "clean_of_benchmark", "secrets", "tokens"]
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op1_quality"](spark, sf).collect()}
    kept = corpus_pipeline.quality(spark, docs, sf).cache()
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {d for d, p in scores.items() if p}
    heads = {r.component_id for r in simhash_dedup.simhash_components(kept).collect()}
    unique = corpus_pipeline.near_dedup(spark, kept, sf).cache()
    assert unique.columns == columns and sorted(r.doc_id for r in unique.collect()) == sorted(heads)
    bad = {r.doc_id for r in decontaminate.report(unique, read_table(spark, sf, "benchmark")).where("contaminated").collect()}
    clean = corpus_pipeline.clean_of_benchmark(spark, unique, sf).cache()
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == heads - bad and bad
    safe = corpus_pipeline.secrets(spark, clean, sf).cache()
    assert safe.columns == columns and safe.dtypes == docs.dtypes and safe.count() == clean.count()
    assert secret_scan.scan(safe, {}).where("size(found) > 0").count() == 0
    assert safe.where("n_chars <> char_length(text)").count() == 0
    last = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.text for r in last} == {r.doc_id: r.text for r in safe.collect()} and len(last) == safe.count()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.word_bpe_path())
    assert all(r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids) for r in last)


def test_pipeline_stages_take_odd_rows(spark):
    schema = read_table(spark, SF_SMALL, "documents").schema
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5),
           (3, "same", None, "s", 4), (3, "same", None, "s", 4), (4, "x " * 50_000, "en", None, 100_000)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == schema.names
            docs.collect()
        assert corpus_pipeline.tokens(spark, docs, SF_SMALL).count() == docs.count()

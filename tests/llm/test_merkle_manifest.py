import hashlib

import pytest
from pyspark.sql import functions as F

from slicewarden.llm import merkle_manifest as mm

SCHEMA = "doc_id long, text string, lang string, n_chars long, proof string, idx long, node string"
COLUMNS = ["doc_id", "lang", "n_chars", "text"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, arity):
    """Root of a list of digests, and the siblings of each, level by level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(where):
            run = at // arity * arity
            paths[k].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + arity])))
            where[k] = at // arity
        nodes = [sha("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def plain_manifest(rows, arity):
    """Sorted (id, leaf, subroot, root, proof) by building every tree in memory."""
    groups = {}
    for doc, text, lang, n in rows:
        groups.setdefault(lang, []).append((doc, plain_leaf(doc, lang, n, text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        leaves = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((leaves, *climb([h for _, h in leaves], arity)))
    root, above = climb([t[1] for t in trees], arity)
    return sorted((str(doc), leaf, sub, root, tuple(path + up)) for (leaves, sub, paths), up in zip(trees, above)
                  for (doc, leaf), path in zip(leaves, paths))


def odd_rows():
    rows = [(k, f"text {k} é" * (k % 5), ["en", "de", None, "fr", "Zz", ""][k % 6], k) for k in range(61)]
    rows += [(None, None, None, None), (None, "no id", "en", 3), (7, "same id", "de", 1), (7, "same id", "de", 1),
             (100, "x" * 300_000, "one", None), (-5, "", "en", 2 ** 63 - 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_matches_trees_built_in_memory(spark, arity):
    rows = odd_rows()
    found = mm.manifest(frame(spark, rows), "doc_id", "lang", COLUMNS, arity,
                        keep={"back": F.concat(F.lit("k"), F.col("n_chars").cast("string"))})
    got = found.select("*", mm.proof_text(F.col("proof")).alias("siblings"),
                       mm.fold(F.col("leaf"), F.col("proof")).alias("up")).collect()
    assert all(r["up"] == r["root"] for r in got)
    steps = lambda proof: tuple((bytes(s["left"]).hex(), bytes(s["right"]).hex()) for s in proof)
    assert sorted((str(r["id"]), r["leaf"], r["subroot"], r["root"], steps(r["proof"])) for r in got) == (
        plain_manifest(rows, arity))
    assert sorted(r["back"] or "" for r in got) == sorted(f"k{n}" if n is not None else "" for *_, n in rows)
    assert sorted(r["siblings"] for r in got) == sorted("".join(a + b for a, b in x[4])
                                                        for x in plain_manifest(rows, arity))


@pytest.mark.parametrize("rows", [[], [(1, "alone", "en", 1)], [(1, "a", "en", 1), (2, "b", "de", None)]])
def test_small_tables(spark, rows):
    got = mm.manifest(frame(spark, rows), "doc_id", "lang", COLUMNS).collect()
    want = plain_manifest(rows, 2) if rows else []
    assert sorted((str(r["id"]), r["leaf"], r["root"]) for r in got) == [(d, h, root) for d, h, _, root, _ in want]


def test_hot_group_and_equal_rows(spark):
    rows = [(5, "copy", "en", 1)] * 300 + [(k, "t", "en", k) for k in range(40)]
    got = mm.manifest(frame(spark, rows), "doc_id", "lang", COLUMNS)
    assert {r["root"] for r in got.collect()} == {plain_manifest(rows, 2)[0][3]}


def test_verify_finds_what_changed(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    found = mm.manifest(frame(spark, rows), "doc_id", "lang", COLUMNS)
    now = [(d, (t or "") + "!" if d in (3, 100) else t, g, n) for d, t, g, n in rows] + [(999, "new", "en", 0)]
    got = {r["id"]: r["verified"] for r in mm.verify(frame(spark, now), found, "doc_id", COLUMNS).collect()}
    assert {d for d, ok in got.items() if not ok} == {3, 100, 999} and len(got) == len(now)


def test_arity_below_two(spark):
    with pytest.raises(ValueError):
        mm.manifest(frame(spark, []), "doc_id", "lang", COLUMNS, 1)

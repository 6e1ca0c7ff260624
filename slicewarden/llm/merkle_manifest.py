"""Merkle dataset manifest: a root over every row, and a proof for each row.

A row's leaf is the digest of its columns.  Within a group, leaves ascend by
id; while a group has several nodes, every ``arity`` consecutive ones (the last
run may hold fewer, even one) become their digest.  What remains is the
group's subroot; the subroots, ordered by group, give the root the same way.

Levels are built by sibling-shift self-joins: a node's siblings have computed
indices (index XOR 1 for pairs, slot offsets otherwise), an equality join
fetches them, and the rows of slot zero emit the parents.  Each level is a
stored table of half (one ``arity``-th) the rows of the one below.  Proofs go
the other way: every level joins its parents' proofs, so the work is that of
one pass over about two tables of leaves, whatever the number of levels.

All keys of these joins are (group number, node index), which no group can make
hot; positions come from a range-partitioned sort with a tie-break, so equal
rows spread as well.

Defined cases: a null value is written ``-`` in the leaf; null ids and null
groups come first and take part like others; rows with equal ids are ordered by
their leaf; repeated rows are leaves of their own; an empty table gives an
empty manifest.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import stored
from slicewarden.operators.dedupe import global_positions

STEP = "struct<left: binary, right: binary>"
CUT = 6                          # proof joins between two stored tables


def leaf_digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values, each as its UTF-8 byte count, a
    colon and its text, ``-`` if null."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _digest(*parts: Column) -> Column:
    """Binary SHA-256 of digests written as hex text."""
    return F.unhex(F.sha2(F.concat(*[_hex(p) for p in parts]), 256))


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Every node with its siblings left and right of it, joined to bytes."""
    slot, none = F.col("idx") % arity, F.lit(b"")
    out, left, right = nodes, [], []
    for offset in range(1, arity):
        other = nodes.select(F.col("gid").alias("g"), F.col("idx").alias("i"), F.col("node").alias(f"s{offset}"))
        at = (F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2
              else F.col("idx") - slot + (slot + offset) % arity)
        out = out.join(other, (F.col("gid") == F.col("g")) & (at == F.col("i")), "left").drop("g", "i")
        sibling = F.coalesce(f"s{offset}", none)
        right.append(F.when(slot + offset < arity, sibling).otherwise(none))
        left.append(F.when(slot + offset >= arity, sibling).otherwise(none))
    return out.select(*nodes.columns, F.concat(*left).alias("left"), F.concat(*right).alias("right"))


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above, emitted by the rows of slot zero."""
    return level.where(F.col("idx") % arity == 0).select(
        "gid", F.expr(f"idx div {arity}").alias("idx"), F.ceil(F.col("n") / arity).cast("long").alias("n"),
        _digest(F.col("node"), F.col("right")).alias("node"))


def build(leaves: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the trees over ``leaves`` (gid, idx, n nodes of its group,
    node, more columns), lowest first, and each group's last node (gid, node, depth).
    ``n`` is that of the row's own level; finished groups leave the loop."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes, done = [], leaves, None
    while True:
        last = nodes.where("n = 1").select("gid", "node", F.lit(len(levels)).alias("depth"))
        done = last if done is None else done.union(last)
        if most <= 1:
            return levels, done
        levels.append(stored(with_siblings(nodes.where("n > 1"), arity), f"{name}-{len(levels)}"))
        nodes = stored(parents(levels[-1], arity), f"{name}-nodes")
        most = -(-most // arity)


def proofs(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The lowest level's rows with their proof: steps (left, right), lowest
    first.  ``tops`` has a row (gid, depth, proof, more columns) for each tree's
    last node, with the steps above it; a tree without levels is not in."""
    more = [c for c in tops.columns if c not in ("gid", "depth", "proof")]
    above = None
    for depth in range(len(levels), 0, -1):
        ends = tops.where(F.col("depth") == depth).select("gid", F.lit(0).cast("long").alias("idx"), "proof", *more)
        above = ends if above is None else above.union(ends)
        if depth % CUT == 0:
            above = stored(above, "proofs")
        level = levels[depth - 1]
        up = above.select(F.col("gid").alias("g"), F.col("idx").alias("up"), F.col("proof").alias("rest"), *more)
        own = [c for c in level.columns if c not in ("left", "right")]
        step = F.array(F.struct("left", "right")).cast(f"array<{STEP}>")
        above = (level.join(up, (F.col("gid") == F.col("g")) & (F.expr(f"idx div {arity}") == F.col("up")))
                 .select(*(own if depth == 1 else ["gid", "idx"]), F.concat(step, "rest").alias("proof"), *more))
    return above


def manifest(df: DataFrame, id_col: str, group_col: str, columns: list[str], arity: int = 2,
             keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``df``: ``id``, ``leaf``, ``subroot``, ``root`` (hex),
    ``proof`` (array of steps with the digests left and right of the path, as
    bytes) and the columns of ``keep``, computed from ``df``."""
    if arity < 2:
        raise ValueError("arity must be 2 or more")
    keep = keep or {}
    kept = [f"keep_{k}" for k in range(len(keep))]
    rows = stored(df.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
                            F.unhex(leaf_digest(*[F.col(c) for c in columns])).alias("node"),
                            *[c.alias(k) for k, c in zip(kept, keep.values())]), "leaves")
    # Equal rows are interchangeable; the row's place in the stored table spreads them.
    placed = global_positions(rows.withColumn("tie", F.monotonically_increasing_id()),
                              [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), F.col("node"), F.col("tie")],
                              "place", 0)
    placed = stored(placed.drop("tie"), "placed")
    groups = stored(placed.groupBy("grp").agg(F.count("*").alias("n"), F.min("place").alias("start")), "groups")
    groups = stored(global_positions(groups, [F.asc_nulls_first("grp")], "gid", 0), "numbered")
    numbered = groups.select(F.col("grp").alias("g"), "n", "start", "gid")
    leaves = stored(placed.join(numbered, F.col("grp").eqNullSafe(F.col("g")))
                    .select("gid", (F.col("place") - F.col("start")).alias("idx"), "n", "node", "id", *kept),
                    "indexed")

    levels, subroots = build(leaves, arity, "level")
    subroots = stored(subroots, "subroots")
    n_groups = F.lit(groups.count()).cast("long")
    top_leaves = subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("idx"), n_groups.alias("n"),
                                 "node", "depth")
    top_levels, roots = build(top_leaves, arity, "top")
    none = F.array().cast(f"array<{STEP}>")
    ends = roots.select("gid", F.col("depth"), none.alias("proof"), F.col("node").alias("root"))
    if top_levels:
        tops = proofs(top_levels, ends, arity).select(
            F.col("idx").alias("gid"), "depth", "proof", F.col("node").alias("subroot"), "root")
    else:                        # one group (or none): its subroot is the root
        tops = subroots.select("gid", "depth", none.alias("proof"), F.col("node").alias("subroot"),
                               F.col("node").alias("root"))
    tops = stored(tops, "tops")

    cols = ["id", "node", *kept, "proof", "subroot", "root"]
    lone = (leaves.where("n = 1").join(tops.select(F.col("gid").alias("g"), "proof", "subroot", "root"),
                                       F.col("gid") == F.col("g")).select(*cols))
    done = lone if not levels else lone.union(proofs(levels, tops, arity).select(*cols))
    return done.select("id", _hex(F.col("node")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                       _hex(F.col("root")).alias("root"), "proof",
                       *[F.col(k).alias(name) for k, name in zip(kept, keep)])


def proof_text(proof: Column) -> Column:
    """The proof's digests in hex, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root (hex) that ``leaf`` (hex) and its proof lead to."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(_hex(s["left"]), at, _hex(s["right"])), 256))


def verify(df: DataFrame, found: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, leaf now, folded root, verified) of ``df``'s rows against a
    manifest of unique ids; rows that the manifest lacks are not verified."""
    now = df.select(F.col(id_col).alias("id"), leaf_digest(*[F.col(c) for c in columns]).alias("leaf"))
    was = found.select(F.col("id").alias("was"), "proof", "root")
    back = fold(F.col("leaf"), F.col("proof"))
    return (now.join(was, now["id"].eqNullSafe(was["was"]), "left")
            .select("id", "leaf", back.alias("folded_root"), F.coalesce(back == F.col("root"), F.lit(False))
                    .alias("verified")))

"""Embedding near-duplicates by E8 lattice hashing.

Each table projects unit vectors to blocks of eight random dimensions and
decodes every block to the nearest point of the E8 lattice; the points, the
label and the dimension are a cell.  A vector is filed under its own cell and
looked up in that cell and the nearest neighbouring ones.  Vectors that meet
are compared by cosine in double precision.

Copies and tight groups never become pairs.  Equal vectors are one point with a
weight.  Points of one coarse cell within half the threshold's angle of the
cell's mean form a clump: by the triangle inequality all of them are linked, so
they need no comparing.  Clumps and single points are the items that are filed,
once per cell, however many points they hold.  Two items that meet are judged
by the angles to their means: a point and a shell of a clump whose angles add
up to less than the threshold are linked whole, and only shells in doubt are
compared point by point.  A group looser than that costs pairs of its points.

A linked pair is found if some table brings its points (or others of their
items) together; ``PLANS`` holds parameters for 0.98 at the threshold itself,
more above it.  Two single points whose signs under 64 random
projections differ further than five standard deviations are not compared.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and those with a null label, link with nothing; vectors of
different length never link; repeated rows are vectors of their own; null ids
take part and get the smallest id of their component, null if none; an empty
table gives an empty result.  Only the id, vector and label are read, so other
columns may have any name.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.llm.common import stored
from slicewarden.llm.simhash_dedup import component_labels

# For up to so many points of one label, at which the unrelated points a point
# meets stay in the dozens -> blocks, tables, probes beside the own cell, and
# the lattice scale times the threshold's distance.  Pairs at the threshold are
# found with 0.98 to 0.99 by any of them (measured on random pairs in 64
# dimensions); unrelated ones meet at rates of 6e-3, 1e-4, 6e-6 and 9e-7.
PLANS = {10_000: (1, 6, 4, 0.318), 500_000: (2, 8, 12, 0.24), 10_000_000: (3, 12, 24, 0.21),
         1 << 62: (4, 16, 48, 0.19)}
CLUMP_SCALE = 0.19               # the same for the clumps' cells
SHELLS = 8
BITS = 64
EPS = 1e-9


# -- lattice -------------------------------------------------------------------

def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: steps to neighbouring points."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum."""
    near = np.rint(x)
    off = x - near
    k = np.abs(off).argmax(1)
    rows = np.flatnonzero(near.sum(1) % 2 != 0)
    near[rows, k[rows]] += np.where(off[rows, k[rows]] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: E8 is D8 and D8 shifted by one half."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _point_hash(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of lattice points (last axis)."""
    out = np.full(points.shape[:-1], salt, np.uint64)
    twice = np.rint(2 * points).astype(np.int64).view(np.uint64)
    for k in range(8):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + twice[..., k])
    return out


def cells(x: np.ndarray, seed: list[int], blocks: int, scale: float, probes: int) -> np.ndarray:
    """Hashes of each row's own cell and its ``probes`` nearest neighbours, own
    first.  A neighbour moves some blocks by a shortest lattice vector; the
    nearest are those whose extra squared distances add up to least."""
    rng = np.random.default_rng(seed)
    gauss, shift, steps = rng.standard_normal((x.shape[1], 8 * blocks)) * scale, rng.random(8 * blocks) * 2, roots()
    at = x @ gauss + shift
    cost, key = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.uint64)
    for k in range(blocks):
        part = at[:, 8 * k:8 * k + 8]
        own = decode(part)
        points, extra = own[:, None, :], np.zeros((len(x), 1))
        if probes:
            gain = (part - own) @ steps.T
            best = np.argpartition(-gain, probes, axis=1)[:, :probes]
            points = np.concatenate([points, own[:, None, :] + steps[best]], axis=1)
            extra = np.concatenate([extra, 2 - 2 * np.take_along_axis(gain, best, 1)], axis=1)
        joined = (cost[:, :, None] + extra[:, None, :]).reshape(len(x), -1)
        hashed = (_mix(key[:, :, None] + np.uint64(0x632BE59BD9B4E019)) ^ _point_hash(points, k + 1)[:, None, :])
        hashed = hashed.reshape(len(x), -1)
        # The own cell has cost 0, the least there is, and so stays first.
        keep = np.argsort(joined, axis=1, kind="stable")[:, :probes + 1]
        cost, key = np.take_along_axis(joined, keep, 1), np.take_along_axis(hashed, keep, 1)
    return key


def sketch(x: np.ndarray, seed: list[int]) -> np.ndarray:
    signs = x @ np.random.default_rng(seed).standard_normal((x.shape[1], BITS)) > 0
    return np.packbits(signs, axis=1, bitorder="little").view("<i8")[:, 0]


def sketch_bits(cosine: float) -> int:
    """Differing sketch bits that a pair at ``cosine`` practically never exceeds."""
    share = math.acos(cosine) / math.pi
    return min(BITS, math.ceil(BITS * share + 5 * math.sqrt(BITS * share * (1 - share))))


# -- points --------------------------------------------------------------------

def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for the rows of each length of a list column."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, start = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[(start[rows][:, None] + np.arange(n))] if n else np.zeros((len(rows), 0))


def unit(values) -> np.ndarray | None:
    """The direction of a vector; None if it has none."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    v = np.array(values, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top                  # squares of the components neither overflow nor vanish
    return v / np.sqrt((v * v).sum())


def directions(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, pid, label, v): ``pid`` tells different vectors apart, null for
    rows that link with nothing."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, pids, vectors = batch.column(2).to_pylist(), [], []
            for values, label in zip(batch.column(1).to_pylist(), labels):
                v = unit(values) if label is not None else None
                vectors.append(v)
                data = None if v is None else label.encode() + b"\0" + np.array(values, np.float64).tobytes()
                pids.append(None if v is None else hashlib.blake2b(data, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pids, pa.binary()), batch.column(2),
                 pa.array(vectors, pa.list_(pa.float64()))], ["id", "pid", "label", "v"])

    return (df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                      F.col(label_col).cast("string").alias("label"))
            .mapInArrow(run, f"id {id_type}, pid binary, label string, v array<double>"))


def with_cells(points: DataFrame, threshold: float, plan: tuple, seed: int) -> DataFrame:
    """Adds dim, cell (of the clumps), homes, probes (hashes, a home among its
    own probes) and sketch."""
    blocks, tables, probes, scale = plan
    reach = math.sqrt(2 - 2 * threshold)
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            dim, cell, sk = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
            found = np.zeros((n, tables, probes + 1), np.int64)
            salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
                             for x in batch.column("label").to_pylist()], np.uint64)
            for rows, x in matrices(batch.column("v")):
                d = x.shape[1]
                dim[rows] = d
                cell[rows] = cells(x, [seed, d, 0], blocks, CLUMP_SCALE / reach, 0)[:, 0].view(np.int64)
                sk[rows] = sketch(x, [seed, d, 1])
                for t in range(tables):
                    key = cells(x, [seed, d, 2 + t], blocks, scale / reach, probes)
                    key = _mix(key + _mix(salt[rows] + np.uint64(1_000_003 * d + t))[:, None])
                    found[rows, t] = key.view(np.int64)

            def lists(a):
                at = pa.array(np.arange(n + 1, dtype=np.int32) * (a.size // max(n, 1)))
                return pa.ListArray.from_arrays(at, pa.array(a.reshape(-1)))

            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dim), pa.array(cell), lists(found[:, :, 0]), lists(found), pa.array(sk)],
                [*names, "dim", "cell", "homes", "probes", "sketch"])

    more = "dim int, cell long, homes array<long>, probes array<long>, sketch long"
    ddl = ", ".join(f"{c} {t}" for c, t in points.dtypes) + ", " + more
    return points.mapInArrow(run, ddl)


@F.arrow_udf(T.DoubleType())
def angle(a: pa.Array, b: pa.Array) -> pa.Array:
    """Angle between unit vectors, exact for small ones too."""
    out = np.zeros(len(a))
    for (rows, x), (_, y) in zip(matrices(a), matrices(b)):
        out[rows] = 2 * np.arcsin(np.minimum(1.0, np.sqrt(((x - y) ** 2).sum(1)) / 2))
    return pa.array(out)


@F.arrow_udf(T.DoubleType())
def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    out = np.zeros(len(a))
    for (rows, x), (_, y) in zip(matrices(a), matrices(b)):
        out[rows] = (x * y).sum(1)
    return pa.array(out)


# -- items ---------------------------------------------------------------------

def with_items(points: DataFrame, theta: float) -> DataFrame:
    """Points with the item they belong to (``iid``), its mean and the angle to
    it, 0 for points that are items by themselves."""
    group = ["cell", "label", "dim"]
    width = points.agg(F.max("dim")).first()[0] or 0
    means = points.groupBy(*group).agg(F.count("*").alias("n"), F.array(
        *[F.avg(F.get("v", F.lit(k))) for k in range(width)]).alias("mean")).where("n > 1")
    mean = F.slice("mean", 1, F.col("dim"))
    norm = F.sqrt(F.aggregate(mean, F.lit(0.0), lambda s, x: s + x * x))
    means = stored(means.withColumn("norm", norm).where("norm > 0")
                   .select(*[F.col(c).alias(f"of_{c}") for c in group],
                           F.transform(mean, lambda x: x / F.col("norm")).alias("mean")), "means")
    on = [F.col(c) == F.col(f"of_{c}") for c in group]
    near = points.join(means, on, "left").withColumn(
        "angle", F.when(F.col("mean").isNotNull(), angle("v", F.coalesce("mean", "v"))))
    inside = F.col("angle") <= theta / 2 - EPS
    clump = F.unhex(F.md5(F.concat_ws("\0", F.lit("clump"), *group).cast("binary")))
    return stored(near.select(
        "pid", "label", "dim", "v", "weight", "first", "homes", "probes",
        F.when(inside, clump).otherwise(F.col("pid")).alias("iid"),
        F.when(inside, F.col("mean")).otherwise(F.col("v")).alias("mean"),
        F.when(inside, F.col("angle")).otherwise(0.0).alias("angle"),
        F.when(~F.coalesce(inside, F.lit(False)), F.col("sketch")).alias("sketch"),
        F.when(inside, F.least(F.lit(SHELLS - 1), F.floor(F.col("angle") / (theta / 2) * SHELLS))).otherwise(-1)
        .cast("int").alias("shell")), "members")


def candidates(members: DataFrame, bits: int) -> DataFrame:
    """Pairs (x < y) of items that meet in a cell."""
    def filed(column: str, name: str) -> DataFrame:
        return (members.select(F.explode(column).alias("key"), "iid", "sketch").distinct()
                .select("key", F.col("iid").alias(name), F.col("sketch").alias(f"{name}_sketch")))

    far = F.bit_count(F.col("a_sketch").bitwiseXOR(F.col("b_sketch"))) > bits
    met = (filed("homes", "a").join(filed("probes", "b"), "key")
           .where((F.col("a") != F.col("b")) & ~F.coalesce(far, F.lit(False))))
    return met.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()


def vector_links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.93, plan: tuple | None = None, seed: int = 11) -> DataFrame:
    """One row per row of ``df``: id, n_links, component_id, kept (id is the
    component's smallest)."""
    theta = math.acos(threshold)
    rows = stored(directions(df, id_col, vector_col, label_col), "directions")
    points = stored(rows.where("pid is not null").groupBy("pid").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"),
        F.min("id").alias("first")), "points")
    if plan is None:
        most = points.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        plan = next(p for limit, p in PLANS.items() if most <= limit)
    members = with_items(stored(with_cells(points, threshold, plan, seed), "cells"), theta)
    items = stored(members.groupBy("iid").agg(
        F.sum("weight").alias("weight"), F.max("angle").alias("radius"), F.min("first").alias("first"),
        F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("mean").alias("mean")), "items")

    # Items that meet, and whose points could be linked.
    def side(name: str) -> DataFrame:
        return items.select(F.col("iid").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in
                                                        ("label", "dim", "mean", "radius", "weight")])

    met = (candidates(members, sketch_bits(threshold)).join(side("x"), "x").join(side("y"), "y")
           .where((F.col("x_label") == F.col("y_label")) & (F.col("x_dim") == F.col("y_dim"))))
    met = met.select("x", "y", "x_weight", "y_weight", (F.col("x_radius") + F.col("y_radius")).alias("radii"),
                     angle("x_mean", "y_mean").alias("apart"), cosine("x_mean", "y_mean").alias("cos"))
    near = stored(met.where((F.col("apart") <= theta + F.col("radii") + EPS)
                            & ((F.col("radii") > 0) | (F.col("cos") >= threshold))), "near")
    plain, mixed = near.where("radii = 0"), near.where("radii > 0")
    found = [plain.select("x", "y", F.col("x").alias("pid"), F.col("y_weight").alias("links")),
             plain.select("x", "y", F.col("y").alias("pid"), F.col("x_weight").alias("links"))]

    # A clump's points against the other item's shells, in both directions.
    ways = mixed.select("x", "y").union(mixed.select("y", "x"))
    shells = members.groupBy(F.col("iid").alias("y"), "shell").agg(
        F.max("angle").alias("out"), F.sum("weight").alias("in_shell"))
    own = members.select(F.col("iid").alias("x"), "pid", "v")
    faced = (ways.join(own, "x").join(items.select(F.col("iid").alias("y"), F.col("mean").alias("to")), "y")
             .withColumn("away", angle("v", "to")).drop("to").join(shells, "y"))
    faced = stored(faced.where(F.col("away") - F.col("out") <= theta + EPS), "faced")
    sure = F.col("away") + F.col("out") <= theta - EPS
    found.append(faced.where(sure).select("x", "y", "pid", F.col("in_shell").alias("links")))
    there = members.select(F.col("iid").alias("y"), "shell", F.col("v").alias("w"), "weight")
    doubt = faced.where(~sure).select("x", "y", "pid", "v", "shell").join(there, ["y", "shell"])
    found.append(doubt.where(cosine("v", "w") >= threshold).select("x", "y", "pid", F.col("weight").alias("links")))

    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    links = stored(links.groupBy("pid", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
                   .agg(F.sum("links").alias("links")), "links")
    labels = component_labels(stored(links.select("x", "y").distinct(), "edges")).select(
        F.col("fp").alias("iid"), "root")
    heads = stored(items.select("iid", "first", "weight").join(labels, "iid", "left")
                   .select("iid", "first", "weight", F.coalesce("root", "iid").alias("root")), "heads")
    firsts = stored(heads.groupBy("root").agg(F.min("first").alias("component")), "firsts")
    known = heads.join(firsts, "root").select("iid", "component", F.col("weight").alias("around"))
    counts = links.groupBy("pid").agg(F.sum("links").alias("links"))
    result = stored(members.select("pid", "iid").join(counts, "pid", "left").join(known, "iid")
                    .select("pid", "component", (F.col("around") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
                    "counted")
    out = rows.select("id", "pid").join(result.withColumnRenamed("pid", "of"), F.col("pid") == F.col("of"), "left")
    component: Column = F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))

"""Lineage graph operators.

A graph is two DataFrames: ``nodes(id, type, name)`` with type JOB or DATASET,
and directed ``edges(source, target)`` between node ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewarden.functions.joins import HOT_ROWS, broadcast_if_few, hot_keys, hot_split_lookup
from slicewarden.session import materialize, stored

# Fixed value: jobs whose name starts with this are system jobs and ignored.
SYSTEM_JOB_PREFIX = "bootstrap."


def is_system_job(name) -> F.Column:
    c = F.col(name) if isinstance(name, str) else name
    return c.startswith(SYSTEM_JOB_PREFIX)


def job_io_edges(nodes: DataFrame, edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct (job_name, direction, dataset) with direction 'in' or 'out'.

    Both endpoints are resolved by inner joins on the node id (edges with an
    unknown endpoint drop out); edges touching a system job are ignored.
    """
    ends_of = nodes.where(F.col("type").isin("JOB", "DATASET"))
    src, dst = [ends_of.select(F.col("id").alias(f"__{e[0]}id"), (F.col("type") == "JOB").alias(f"{e}_job"),
                               F.col("name").alias(f"{e}_name")) for e in ("src", "tgt")]
    # A job may own a large share of all edges: hot node ids are salted.  Both
    # ends' hot ids are counted on the edges, not on the first lookup's result.
    ends = edges.select("source", "target")
    hot_targets = hot_keys(ends, "target", hot_rows)
    # An id that was resolved is not carried on: the next shuffle holds what is needed.
    e = hot_split_lookup(ends, src, "source", "__sid", hot_rows).select("target", "src_job", "src_name")
    e = hot_split_lookup(e, dst, "target", "__tid", hot_rows, hot=hot_targets)
    # One pass: JOB→DATASET is an output of the job, DATASET→JOB an input.
    is_out = F.col("src_job")
    io = e.where(F.col("src_job") != F.col("tgt_job")).select(
        F.when(is_out, F.col("src_name")).otherwise(F.col("tgt_name")).alias("job_name"),
        F.when(is_out, F.lit("out")).otherwise(F.lit("in")).alias("direction"),
        F.when(is_out, F.col("tgt_name")).otherwise(F.col("src_name")).alias("dataset"))
    return io.where(~is_system_job("job_name")).distinct()


def job_io_lists(io_edges: DataFrame) -> DataFrame:
    """Per job: sorted distinct inputs and outputs.  The lists hold distinct
    dataset names of one job (graph metadata); the long form from
    :func:`job_io_edges` is what the planner joins on."""
    return io_edges.groupBy("job_name").agg(
        F.sort_array(F.collect_list(F.when(F.col("direction") == "in", F.col("dataset")))).alias("inputs"),
        F.sort_array(F.collect_list(F.when(F.col("direction") == "out", F.col("dataset")))).alias("outputs"),
    )


def produced_datasets(io_edges: DataFrame) -> DataFrame:
    """Distinct datasets written by some (non-system) job."""
    return io_edges.where(F.col("direction") == "out").select("dataset").distinct()


def root_job_name(root: str) -> str:
    name = root.split(":", 1)[-1]
    if name.startswith(SYSTEM_JOB_PREFIX):
        raise ValueError(f"system job is not a valid root: {name}")
    return name


def neighbourhood(nodes: DataFrame, edges: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges one hop around the root job (its inputs and outputs).

    Filters on the root's node ids through semi joins.  The ids are few (one a
    namespace) and broadcast, so the edges are filtered where they lie; so are
    the nodes unless the root has very many neighbours.
    """
    job = root_job_name(root)
    root_ids = F.broadcast(nodes.where((F.col("type") == "JOB") & (F.col("name") == job))
                           .select(F.col("id").alias("__rid")))
    # Two equi semi joins (outputs, inputs) rather than one OR condition,
    # which would not be an equi-join.
    touching = (edges.join(root_ids, edges["source"] == root_ids["__rid"], "left_semi")
                .unionByName(edges.join(root_ids, edges["target"] == root_ids["__rid"], "left_semi"))
                .distinct())
    touching = materialize(touching)
    ends = touching.select(F.col("source").alias("id")).unionByName(touching.select(F.col("target").alias("id"))).distinct()
    hood_nodes = materialize(nodes.join(broadcast_if_few(materialize(ends)), "id", "left_semi"))
    return hood_nodes, touching


def downstream(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(id, depth): every node that the edges (source, target) lead to from
    ``roots`` (column ``id``, depth 0), with the fewest hops it takes.

    One hop a round: the newest nodes meet the edges, and nodes seen before drop
    out, so cycles end.  The edges are made distinct and written once, each
    round's nodes too; a round reads the edges and shuffles them only if it
    starts from more nodes than are broadcast.  Ends after ``max_depth`` hops,
    or when a round finds nothing new.
    """
    hops = stored(edges.select("source", "target").distinct(), "hops")
    newest = materialize(roots.select("id").distinct().withColumn("depth", F.lit(0)))
    seen, depth = newest, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        start = broadcast_if_few(newest.select("id"))
        reached = (hops.join(start, hops["source"] == start["id"], "left_semi")
                   .select(F.col("target").alias("id")).distinct())
        newest = materialize(reached.join(seen, "id", "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            break
        seen = seen.unionByName(newest)
        if depth % 8 == 0:               # one table again: the union does not grow with the depth
            seen = materialize(seen)
    return seen


def root_graph(nodes: DataFrame, edges: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """The root's neighbourhood as the graph to plan from.  A system job or a
    job that is not in the graph raises ``ValueError``."""
    job = root_job_name(root)
    if nodes.where((F.col("type") == "JOB") & (F.col("name") == job)).isEmpty():
        raise ValueError(f"job not found in the lineage graph: {job}")
    return neighbourhood(nodes, edges, root)


def job_io_chunks(io_edges: DataFrame, chunk_size: int = 10_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per job and direction, the sorted distinct datasets in numbered chunks
    of at most ``chunk_size`` (job_name, direction, chunk, datasets).

    The bounded form of :func:`job_io_lists` for jobs with very many
    datasets: every dataset appears exactly once, in order, and no group
    collected by one task exceeds ``chunk_size``.  Positions come from a
    global sort; each (job, direction) group's first position is looked up
    with the hot-key-safe join.
    """
    from slicewarden.operators.dedupe import global_positions

    keyed = io_edges.select("job_name", "direction", "dataset",
                            F.concat_ws("\u0000", "job_name", "direction").alias("__g"))
    pos = global_positions(keyed, [F.col("job_name"), F.col("direction"), F.col("dataset")], name="__p")
    starts = pos.groupBy(F.col("__g").alias("__g0")).agg(F.min("__p").alias("__s"))
    j = hot_split_lookup(pos, starts, "__g", "__g0", hot_rows)
    chunk = F.floor((F.col("__p") - F.col("__s")) / F.lit(chunk_size)).cast("long")
    return (j.groupBy("job_name", "direction", chunk.alias("chunk"))
            .agg(F.sort_array(F.collect_list("dataset")).alias("datasets")))

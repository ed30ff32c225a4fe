"""Near-duplicate vectors by NN-descent.

A neighbour graph starts from a few trees of random-hyperplane buckets and is
refined by rounds of neighbours-of-neighbours joins until hardly a list still
changes; a round joins only around entries that are new.  Its edges at or above
the threshold make clusters.  A list whose members are all that near is
saturated: what it has no room for is kept as ties, and it is enlarged to its
whole cluster, which is compared block by block, so every link inside a cluster
is found and counted exactly without writing out the pairs.  Some vectors are
compared with all others by brute force; while too few of their links were
found, as many trees again start new entries and the rounds go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import components, importable, load
from candleflow.llm.vectors import matrix, unit, usable
from candleflow.plans.sizing import bounded_broadcast
from candleflow.session import materialize

THRESHOLD = 0.9
NEIGHBOURS = 8
TREES, MOST_TREES = 4, 4096
#: Rounds go on while more than this share of the lists' entries is new.
SETTLED = 0.01
#: Rows compared with each other at once; usual size of a starting bucket.
BLOCK, BUCKET = 1024, 256
AUDIT, RECALL = 64, 0.99
#: Vectors compared with all others at most, and numbers that these may hold.
AUDIT_MOST, AUDIT_SIZE = 8192, 1 << 22
#: Similarities of the graph are of single precision; clusters take in so much below the threshold.
SLACK = 1e-4


def _trees(bits: int, threshold: float, recall: float, least: int = TREES) -> int:
    """Trees of ``bits`` hyperplanes in which a pair at the threshold shares a
    bucket at least once with probability ``recall``."""
    alone = 1 - (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits
    return max(least, int(np.ceil(np.log(1 - recall) / np.log(alone)))) if 0 < alone < 1 else least


def _labels(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the smallest row reachable."""
    label = np.arange(len(near))
    rows = np.flatnonzero(near.any(axis=1))
    part = near[np.ix_(rows, rows)]
    while len(rows):
        low = np.minimum(label[rows], np.where(part, label[rows][None, :], len(near)).min(axis=1))
        if (low == label[rows]).all():
            break
        label[rows] = low
    return label


def _hashed(batches: Iterator[pa.RecordBatch], dim: int, bits: int, trees: int, seed: int) -> Iterator[pa.RecordBatch]:
    planes = np.random.default_rng(seed).normal(size=(dim, trees * bits))
    weights = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        u = unit(matrix(batch.column("v"), dim))
        codes = ((u @ planes) > 0).reshape(len(u), trees, bits) @ weights if bits else np.zeros((len(u), trees), np.int64)
        for t in range(trees):
            yield pa.record_batch([pa.array(np.full(len(u), t, np.int32)), pa.array(codes[:, t]), batch.column("id")], names=["tree", "bucket", "id"])


def _units(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [x.tobytes() for x in unit(matrix(batch.column("v"), dim)).astype("<f4")]
        yield pa.record_batch([batch.column("id"), pa.array(raw, pa.binary())], names=["id", "u"])


def _singles(column: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f4").reshape(-1, dim)


def _started(rows: pd.DataFrame, dim: int, k: int, least: float) -> pd.DataFrame:
    """The k nearest of each row within a block, and the block's clusters: a
    row of similarity 2 ties a member to the smallest of its cluster."""
    rows = rows.sort_values("id")
    ids, u = rows["id"].to_numpy(), _singles(rows["u"], dim)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    k = min(k, len(ids) - 1)
    if k < 1:
        return pd.DataFrame({"a": ids[:0], "b": ids[:0], "s": np.zeros(0, np.float32)})
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    label = _labels(s >= least)
    tied = np.flatnonzero(label != np.arange(len(ids)))
    return pd.DataFrame({
        "a": np.concatenate([np.repeat(ids, k), ids[tied]]), "b": np.concatenate([ids[near].reshape(-1), ids[label[tied]]]),
        "s": np.concatenate([np.take_along_axis(s, near, 1).reshape(-1), np.full(len(tied), 2, np.float32)])})


def _joined(batches: Iterator[pa.RecordBatch], dim: int, least: float) -> Iterator[pa.RecordBatch]:
    """Among the members of each centre, the pairs with a new entry that
    better either's list; and ties (similarity 2) within the clusters of those
    that are ``least`` near but find no room in a list."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            lists = batch.column("members").slice(lo, 256)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            ids, kth, fresh = flat.field("id").to_numpy(), flat.field("kth").to_numpy(), flat.field("fresh").to_numpy(zero_copy_only=False)
            u = np.frombuffer(b"".join(flat.field("u").to_pylist()), "<f4").reshape(-1, dim)
            g, w = len(sizes), int(sizes.max(initial=0))
            row = np.repeat(np.arange(g), sizes)
            col = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x, names, bar = np.zeros((g, w, dim), np.float32), np.full((g, w), -1, np.int64), np.full((g, w), 9, np.float32)
            new = np.zeros((g, w), bool)
            x[row, col], names[row, col], bar[row, col], new[row, col] = u, ids, kth, fresh
            s = x @ x.transpose(0, 2, 1)
            pair = (new[:, :, None] | new[:, None, :]) & (names[:, :, None] < names[:, None, :]) & (names[:, :, None] >= 0)
            better = pair & (s > np.minimum(bar[:, :, None], bar[:, None, :]))
            c, i, j = np.nonzero(better)
            a, b, v = names[c, i], names[c, j], s[c, i, j]
            crowded = pair & (s >= least) & ~better
            low, high = [], []
            for centre in np.flatnonzero(crowded.any(axis=(1, 2))):
                near = crowded[centre] | crowded[centre].T
                label = _labels(near)
                tied = np.flatnonzero(label != np.arange(w))
                low.append(names[centre, tied])
                high.append(names[centre, label[tied]])
            ties = np.concatenate(low) if low else ids[:0]
            yield pa.record_batch([
                pa.array(np.concatenate([a, b, ties])), pa.array(np.concatenate([b, a, np.concatenate(high) if high else ids[:0]])),
                pa.array(np.concatenate([v, v, np.full(len(ties), 2, np.float32)]))], names=["a", "b", "s"])


def _nearest(edges: DataFrame, key: str, k: int) -> DataFrame:
    other = "b" if key == "a" else "a"
    order = Window.partitionBy(key).orderBy(F.desc("s"), other)
    return edges.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def _counted(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of the rows of one piece of work: inside each cluster if the
    piece holds whole clusters, else between its two blocks."""
    out = []
    for _, part in rows.sort_values(["root", "id"]).groupby("root"):
        ids, v, copies, block = part["id"].to_numpy(), unit(np.stack(part["v"])), part["copies"].to_numpy(), part["block"].to_numpy()
        near = v @ v.T >= threshold
        np.fill_diagonal(near, False)
        if part["lo"].iat[0] != part["hi"].iat[0]:
            near &= block[:, None] != block[None, :]
        label = ids[_labels(near)]
        out.append(pd.DataFrame({"id": ids, "links": near @ copies, "label": label}))
    return pd.concat(out)


def _brute(batches: Iterator[pa.RecordBatch], dim: int, ids: np.ndarray, v: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    total, nodes = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for batch in batches:
        others, copies = batch.column("id").to_numpy(), batch.column("copies").to_numpy()
        u = unit(matrix(batch.column("v"), dim)).T
        for lo in range(0, len(ids), BLOCK):
            near = (v[lo : lo + BLOCK] @ u >= threshold) & (ids[lo : lo + BLOCK, None] != others[None, :])
            total[lo : lo + BLOCK] += near @ copies
            nodes[lo : lo + BLOCK] += near.sum(axis=1)
    yield pa.record_batch([pa.array(ids), pa.array(total), pa.array(nodes)], names=["id", "true", "near"])


def _audited(nodes: DataFrame, total: int, dim: int, threshold: float, audit: int) -> pd.DataFrame:
    """Some nodes and their links among all: id, true (copies counted), near
    (nodes).  The sample grows until ``audit`` of its nodes have links to at
    most ``BUCKET`` nodes, so lie outside the largest clusters."""
    place = F.pmod(F.xxhash64("id", F.lit(31)), F.lit(1_000_000))
    most = max(audit, min(AUDIT_MOST, AUDIT_SIZE // dim))
    want = audit
    while True:
        sample = nodes.where(place < 1e6 * min(1.0, want / total)).select("id", "v").limit(2 * most).toArrow()  # bounded by most
        if not sample.num_rows:
            if want >= min(most, total):
                return pd.DataFrame({"id": [], "true": [], "near": []}, dtype=np.int64)
        else:
            ids, v = sample["id"].to_numpy(), unit(matrix(sample["v"], dim))
            found = nodes.mapInArrow(lambda it, ids=ids, v=v: _brute(it, dim, ids, v, threshold), "id long, true long, near long").groupBy("id").agg(
                F.sum("true").alias("true"), F.sum("near").alias("near")).toPandas()
            if want >= min(most, total) or ((found["near"] > 0) & (found["near"] <= BUCKET)).sum() >= audit:
                return found
        want = min(8 * want, most)


def _recall(truth: pd.DataFrame, counts: DataFrame) -> float | None:
    """Mean share of their links found over the linked vectors of the audit:
    the lower of those inside the largest clusters and those outside.  None if
    the audit holds no linked vector, so measures nothing."""
    linked = truth[truth["near"] > 0]
    if not len(linked):
        return None
    ids = counts.sparkSession.createDataFrame(linked[["id"]])
    seen = counts.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(F.sum("links").alias("links")).toPandas()
    share = linked["id"].map(seen.set_index("id")["links"]).fillna(0).astype(float) / linked["true"]
    return float(share.groupby(linked["near"] <= BUCKET).mean().min())


def _start(nodes: DataFrame, units: DataFrame, dim: int, bits: int, trees: int, seed: int, k: int, least: float) -> DataFrame:
    """Entries (a, b, s) of neighbour lists, and ties (s = 2), from ``trees``
    trees of buckets; buckets beyond ``BLOCK`` rows are dealt into blocks."""
    codes = materialize(nodes.mapInArrow(lambda it: _hashed(it, dim, bits, trees, seed), "tree int, bucket long, id long"), "codes")
    large = codes.groupBy("tree", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    placed = codes.join(bounded_broadcast(large), ["tree", "bucket"], "left").withColumn("block", F.pmod(F.xxhash64("id", "tree"), F.coalesce("blocks", F.lit(1))))
    return materialize(placed.join(units, "id").groupBy("tree", "bucket", "block").applyInPandas(
        lambda pdf: _started(pdf[["id", "u"]], dim, k, least), "a long, b long, s float"), "start")


def _merged(old: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The lists ``old`` (a, b, s, fresh) with what is ``found`` (a, b, s);
    only entries that were not there are new."""
    both = old.unionByName(found.where("s < 2").withColumn("fresh", F.lit(True)))
    return materialize(_nearest(both.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh")), "a", k), "graph")


def _round(graph: DataFrame, units: DataFrame, dim: int, k: int, least: float) -> DataFrame:
    """What the neighbours of each vector with a new entry are to each other."""
    kth = graph.groupBy("a").agg(F.when(F.count("*") >= k, F.min("s")).otherwise(F.lit(-2.0)).cast("float").alias("kth"))
    members = units.join(kth, F.col("id") == F.col("a"), "left").select("id", "u", F.coalesce("kth", F.lit(-2.0).cast("float")).alias("kth"))
    around = graph.select(F.col("a").alias("centre"), F.col("b").alias("id"), "fresh").union(
        _nearest(graph, "b", k).select(F.col("b").alias("centre"), F.col("a").alias("id"), "fresh"))
    around = around.groupBy("centre", "id").agg(F.max("fresh").alias("fresh"))
    around = around.join(around.where("fresh").select("centre").distinct(), "centre", "left_semi")
    lists = around.join(members, "id").groupBy("centre").agg(F.collect_list(F.struct("id", "kth", "fresh", "u")).alias("members"))
    return materialize(lists.select("members").mapInArrow(lambda it: _joined(it, dim, least), "a long, b long, s float"), "found")


def link_vectors(rows: DataFrame, threshold: float = THRESHOLD, column: str = "embedding", k: int = NEIGHBOURS, trees: int = TREES,
                 settled: float = SETTLED, audit: int = AUDIT, recall: float = RECALL) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links, component_id, kept.

    Vectors link when their cosine, in double precision, is ``threshold`` or
    more.  Vectors that take no part (see
    :func:`candleflow.llm.vectors.usable`) have no links, are their own
    component and are kept; so is a null vec_id, with a null component.  Rows
    that repeat a vec_id are one vector.  Equal vectors are one node of the
    graph that counts for its copies.  An empty table gives no rows.

    A block holds at most about ``BLOCK`` rows wherever a third of all rows
    may fall together: buckets and clusters beyond it are dealt into blocks by
    a hash, and clusters are compared block against block.  The graph starts
    from ``trees`` trees; rounds follow until at most a share ``settled`` of
    the lists' entries is new (1: no round).  Vectors are compared with all
    others until ``audit`` linked ones lie outside the largest clusters; while
    the mean share of their links found is below ``recall``, or while none is
    linked and a pair at the threshold would not yet have met with that
    probability, as many trees again are added and the rounds go on.  A recall
    still too low at ``MOST_TREES`` trees is an error, not a result.
    """
    spark = rows.sparkSession
    importable(spark)
    base, dim = usable(rows, column)
    everything = rows.select(F.col("vec_id").cast("long").alias("vec_id"))
    if not dim:
        return everything.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    base = materialize(base.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), F.col("v")).alias("h2")), "vectors")
    nodes = materialize(base.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")), "nodes")
    total = nodes.count()
    bits = max(0, int(np.ceil(np.log2(max(1, total / BUCKET)))))
    enough, least = _trees(bits, threshold, recall, trees), threshold - SLACK
    truth = _audited(nodes, total, dim, threshold, audit)
    units = materialize(nodes.mapInArrow(lambda it: _units(it, dim), "id long, u binary"), "units")
    graph = spark.createDataFrame([], "a long, b long, s float, fresh boolean")
    known = spark.createDataFrame([], "a long, b long")
    planted, more = 0, trees
    while True:
        found = _start(nodes, units, dim, bits, more, 100 + planted, k, least)
        planted += more
        ties = [found]
        graph = _merged(graph, found, k)
        while True:
            state = graph.agg(F.count_if("fresh").alias("new"), F.count("*").alias("all")).first()
            if state["new"] <= settled * state["all"]:
                break
            found = _round(graph, units, dim, k, least)
            ties.append(found)
            graph = _merged(graph.withColumn("fresh", F.lit(False)), found, k)
        edges = graph.where(F.col("s") >= least).select("a", "b").union(known)
        for t in ties:
            edges = edges.union(t.where("s = 2").select("a", "b"))
        known = materialize(edges.distinct(), "near-edges")
        counts = _compared(nodes, components(known), threshold, total)
        measured = _recall(truth, counts)
        if (planted >= enough) if measured is None else (measured >= recall):
            break
        if planted >= MOST_TREES:
            raise RuntimeError(f"near-duplicate vectors: measured recall {measured} is below {recall} after {planted} trees")
        more = planted
    links = counts.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(counts.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b")))
    per_node = nodes.select("h1", "h2", "id", "copies").join(links, "id", "left").join(roots, "id", "left").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    per_vector = base.select("vec_id", "h1", "h2").join(per_node, ["h1", "h2"]).drop("h1", "h2")
    component = F.coalesce("component_id", "vec_id")
    return everything.join(per_vector, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _compared(nodes: DataFrame, clusters: DataFrame, threshold: float, total: int) -> DataFrame:
    """Partial link counts (id, links, label), one row for each piece of work
    that a node is in; small clusters share pieces of about ``BLOCK`` nodes."""
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    rows = nodes.join(clusters, "id").join(sizes, "root").select("root", "id", "copies", "v", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    paired = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    work = paired.select(
        "root", "id", "copies", "v", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(max(1, -(-total // BLOCK))))).otherwise(F.col("root")).alias("piece"),
        (F.col("blocks") == 1).alias("small"))
    return materialize(work.groupBy("small", "piece", "lo", "hi").applyInPandas(
        lambda pdf: _counted(pdf, threshold), "id long, links long, label long"), "links")


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept vectors among all embeddings."""
    return link_vectors(load(spark, sf_dir, "embeddings"))


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL: all pairs, and the smallest vec_id that links reach."""
    return f"""
with recursive usable as (
    select vec_id, min(cast(embedding as double[])) as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(embedding, lambda c: c <> 0)) > 0
    group by vec_id),
vectors as (select * from usable where len(v) = (select len(v) from usable group by 1 order by count(*) desc, 1 limit 1)),
links as (
    select x.vec_id as a, y.vec_id as b from vectors x join vectors y on x.vec_id <> y.vec_id
    where list_cosine_similarity(x.v, y.v) >= {threshold}),
reach as (
    select a as id, a as other from links
    union select r.id, l.b from reach r join links l on l.a = r.other),
parts as (select id, min(other) as root from reach group by id),
counts as (select a as id, count(*) as n from links group by a)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, coalesce(p.root, e.vec_id)::bigint as component_id,
       coalesce(e.vec_id = coalesce(p.root, e.vec_id), true) as kept
from embeddings e left join counts c on c.id = e.vec_id left join parts p on p.id = e.vec_id"""

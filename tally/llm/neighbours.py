"""Approximate nearest neighbours: NN-descent builds the graph, greedy search answers queries.

Equal vectors are one node, so copies neither crowd the graph nor hide other
neighbours. The first graph comes from a few random projections: nodes are
range-partitioned by a projection and compared within blocks of a fixed size.
NN-descent then joins each node's neighbours (both ways) with one another;
a pair is passed on only if it beats the worst neighbour of one of its nodes,
and each node keeps its K best, until hardly an edge changes in a round.
Queries walk the graph: each round the best
nodes of the beam not yet opened are opened by a join with the graph, their
neighbours scored by a join with the vectors, and the beam keeps the best,
until every node of every beam is opened. Neither has a limit of rounds: edges
and beams only get better, so both end.
All rounds are joins and aggregations over tables; what a node contributes is
bounded by K and by ``MAX_REVERSE``, whatever the data. These bounds are
parts of the approximation, whose recall the tests measure.

Nearness is the cosine. The graph works on unit vectors in single precision;
results are scored again in double precision on the given vectors.

Edge cases. A vector that is null, zero, of another length than most, or holds
null or non-finite components takes no part. Equal scores go to the smaller
id. Repeated rows are candidates of their own, but a query never finds its own
id. Null ids take no part. Fewer candidates than asked for: all of them.
Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tally.llm.stage import staged

#: Parameters: neighbours kept, reverse ones used, block size and projections of the first graph, share of new edges that ends the descent.
K = 24
MAX_REVERSE = 24
BLOCK_ROWS = 1_000
PROJECTIONS = 3
SETTLED = 0.001
#: Beam, nodes opened a round.
BEAM = 384
OPEN = 64


def usable(embeddings: DataFrame, ident: str, vector: str) -> DataFrame:
    """(id, vec as array<double>) of the rows that take part."""
    vec = F.col(f"`{vector}`").cast("array<double>")
    df = embeddings.select(F.col(f"`{ident}`").cast("long").alias("id"), vec.alias("vec"))
    most = F.array_max(F.transform("vec", F.abs))
    # powers of two, so no digit changes and no cosine; squares of the components then neither vanish nor overflow
    factor = F.when(most < 1e-150, F.lit(2.0 ** 600)).when(most > 1e150, F.lit(2.0 ** -600)).otherwise(F.lit(1.0))
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)).select(
        "id", F.transform("vec", lambda x: x * factor).alias("vec"))


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct vector: node (its smallest id) and its unit vector."""
    unit = F.expr("transform(vec, x -> cast(x / sqrt(aggregate(vec, 0D, (a, y) -> a + y * y)) as float))")
    return rows.groupBy("node").agg(F.first("vec").alias("vec")).select("node", unit.alias("unit"))


def best(edges: DataFrame, key: str, score: str, keep: int, tie: str) -> DataFrame:
    """The ``keep`` best rows of each key; the group limit is applied before the shuffle too."""
    order = W.partitionBy(key).orderBy(F.col(score).desc(), tie)
    return edges.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= keep).drop("_rank")


def first_graph(nodes: DataFrame, n: int, dim: int) -> DataFrame:
    """(u, v, s): for each projection, the best of each node's block."""
    blocks = max(1, n // BLOCK_ROWS)

    def within(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        node, x = pdf["node"].to_numpy(), np.stack(pdf["unit"].to_numpy())
        out = []
        keep = min(K, len(node) - 1)
        # a block that many equal projections have swollen is compared in slices of rows
        for lo in range(0, len(node) if keep > 0 else 0, 2048):
            s = x[lo:lo + 2048] @ x.T
            s[np.arange(len(s)), lo + np.arange(len(s))] = -2
            top = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
            out.append(pd.DataFrame({"u": np.repeat(node[lo:lo + 2048], keep), "v": node[top.ravel()], "s": np.take_along_axis(s, top, 1).ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": [], "s": []})

    rng = np.random.default_rng(4)
    parts = []
    for p in range(PROJECTIONS):
        axis = rng.normal(size=dim)
        along = sum((F.col("unit")[i] * float(a) for i, a in enumerate(axis)), F.lit(0.0))
        bounds = nodes.select(along.alias("x")).agg(F.percentile_approx("x", [k / blocks for k in range(1, blocks)] or [0.5], 20_000).alias("cuts"))
        # the block is the number of bounds below the projection
        placed = nodes.withColumn("x", along).join(F.broadcast(bounds)).withColumn(
            "block", F.expr("array_size(cuts)") - F.size(F.filter("cuts", lambda c: c >= F.col("x"))) if blocks > 1 else F.lit(0))
        parts.append(placed.groupBy("block").applyInPandas(within, "u long, v long, s float"))
    graph = parts[0]
    for p in parts[1:]:
        graph = graph.union(p)
    return best(graph.dropDuplicates(["u", "v"]), "u", "s", K, "v")


def descend(graph: DataFrame, nodes: DataFrame, groups: int) -> DataFrame:
    """One NN-descent round: neighbours of a common node meet. (u, v, s, fresh); fresh: not in ``graph``."""
    worst = graph.groupBy("u").agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("k"))
    worst = worst.select(F.col("u").alias("x"), F.when(F.col("k") < K, F.lit(-2.0)).otherwise(F.col("worst")).cast("float").alias("worst"))
    back = best(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "s"), "u", "s", MAX_REVERSE, "v")
    meet = graph.select("u", "v").union(back.select("u", "v")).dropDuplicates(["u", "v"])
    known = nodes.join(worst, F.col("node") == F.col("x"), "left").select(F.col("node").alias("v"), "unit", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"))
    rows = meet.join(known, "v").withColumn("group", F.pmod(F.xxhash64("u"), F.lit(groups)))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "v"], kind="stable")
        u, v, w = (pdf[c].to_numpy() for c in ("u", "v", "worst"))
        x = np.stack(pdf["unit"].to_numpy())
        cuts = np.concatenate([np.flatnonzero(np.diff(u, prepend=u[0] - 1)), [len(u)]])
        a, b, s = [], [], []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            sim = x[lo:hi] @ x[lo:hi].T
            np.fill_diagonal(sim, -2)
            i, j = np.nonzero(sim > w[lo:hi, None])
            a.append(v[lo + i])
            b.append(v[lo + j])
            s.append(sim[i, j])
        # within a task a pair is passed on once
        out = pd.DataFrame({"u": np.concatenate(a), "v": np.concatenate(b), "s": np.concatenate(s)}).drop_duplicates(["u", "v"])
        return out.sort_values("s", ascending=False, kind="stable").groupby("u", sort=False).head(K)

    fresh = rows.groupBy("group").applyInPandas(local, "u long, v long, s float")
    both = graph.select("u", "v", "s", F.lit(False).alias("fresh")).union(fresh.select("u", "v", "s", F.lit(True)))
    return best(both.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh")), "u", "s", K, "v")


def build(nodes: DataFrame) -> DataFrame:
    """The neighbour graph (u, v, s), K best neighbours of every node."""
    shape = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("unit")).alias("dim")).first()
    if not shape["n"]:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v"), F.lit(0.0).cast("float").alias("s"))
    graph = staged(first_graph(nodes, shape["n"], shape["dim"]), "graph")
    while True:
        graph = staged(descend(graph, nodes, max(1, shape["n"] // 2_000)), "graph")
        if graph.filter("fresh").count() <= SETTLED * K * shape["n"]:
            return graph.drop("fresh")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda t, x: t + x)


def walk(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Greedy search: (q, v, s), the beam of every query node (q, unit)."""
    both = staged(graph.select("u", "v").union(best(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "s"), "u", "s", MAX_REVERSE, "v").select("u", "v"))
                  .dropDuplicates(["u", "v"]), "links")
    units = nodes.select(F.col("node").alias("v"), "unit")
    asked = queries.select(F.col("node").alias("q"), F.col("unit").alias("asked"))
    beam = staged(asked.select("q", F.col("q").alias("v"), F.lit(1.0).alias("s"), F.lit(False).alias("opened")), "beam")
    while not beam.filter(~F.col("opened")).isEmpty():
        front = best(beam.filter(~F.col("opened")), "q", "s", OPEN, "v").select("q", F.col("v").alias("u"))
        reached = front.join(both, "u").select("q", "v").distinct().join(beam.select("q", "v"), ["q", "v"], "left_anti")
        scored = reached.join(units, "v").join(asked, "q").select("q", "v", dot(F.col("unit"), F.col("asked")).alias("s"), F.lit(False).alias("opened"))
        marked = beam.join(front.select("q", F.col("u").alias("v"), F.lit(True).alias("now")), ["q", "v"], "left").select(
            "q", "v", "s", (F.col("opened") | F.coalesce("now", F.lit(False))).alias("opened"))
        beam = staged(best(marked.unionByName(scored), "q", "s", BEAM, "v"), "beam")
    return beam


def nearest(embeddings: DataFrame, queries: Column, k: int = 5, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found for every row that ``queries`` (over ``ident``) selects."""
    all_rows = usable(embeddings, ident, vector)
    hashed = staged(all_rows.withColumn("h", F.xxhash64("vec")), "hashed")
    # a node is named by its smallest id, so that equal scores prefer small ids in every cut
    named = hashed.groupBy("h").agg(F.min("id").alias("node"))
    rows = staged(hashed.join(named, "h").select("id", "vec", "node"), "vectors")
    lengths = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.col("count").desc(), "dim").limit(1).select("dim")
    rows = rows.join(F.broadcast(lengths), F.size("vec") == F.col("dim"), "left_semi")
    nodes = staged(nodes_of(rows), "nodes")
    graph = build(nodes)
    wanted = rows.withColumnRenamed("id", ident).filter(queries).withColumnRenamed(ident, "id")
    asked = nodes.join(wanted.select("node").distinct(), "node", "left_semi")
    # the whole beam is ranked exactly: its order is by single-precision scores
    found = walk(asked, graph, nodes).select("q", "v").union(asked.select("node", "node")).distinct()
    # the smallest ids of each vector, first within salts, so that copies never meet in one task
    salted = W.partitionBy("node", F.pmod("id", F.lit(64))).orderBy("id")
    members = rows.withColumn("_rank", F.row_number().over(salted)).filter(F.col("_rank") <= k + 1).drop("_rank")
    members = members.withColumn("_rank", F.row_number().over(W.partitionBy("node").orderBy("id"))).filter(F.col("_rank") <= k + 1)
    ask = wanted.select(F.col("id").alias("query_id"), F.col("node").alias("q"), F.col("vec").alias("asked")).distinct()
    pairs = (ask.join(found, "q").join(members.select(F.col("node").alias("v"), F.col("id").alias("vec_id"), "vec"), "v").filter("query_id <> vec_id"))
    norm = lambda c: F.sqrt(dot(c, c))
    score = dot(F.col("vec"), F.col("asked")) / (norm(F.col("vec")) * norm(F.col("asked")))
    ranked = pairs.select("query_id", "vec_id", score.alias("score")).withColumn(
        "rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

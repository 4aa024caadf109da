"""Distributed list ranking: the position of every item of a linked list.

Items are contracted before anything is shuffled along the list. A range
partition holds neighbouring keys, and a task joins its items to chains as far as
the links stay inside it; only chains remain. If these are still many, an
independent set of them (links from a chain with coin 0 to one with coin 1) is
folded into its predecessors, round by round, a quarter of the list at a time,
so the work of all rounds is a few times the first one's. At most ``BASE``
chains, a fixed number, are ranked in one task; then every fold and chain hands
its positions back.

Edge cases. Empty list: empty result. Several lists (at most a few thousand,
as what is left of each goes to the last task): each counts from 0. Keys must be unique; a null first key column of ``next_`` ends the list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tally.llm.stage import staged

#: Parameters: chains ranked in one task, and items a contracting task aims at.
BASE = 1 << 16
LOCAL_ITEMS = 1 << 19


def _heads(before: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item the first item of its chain and the weights before it there; ``before`` is -1 at heads."""
    at = np.where(before >= 0, before, np.arange(len(before)))
    off = np.where(before >= 0, weight[before], 0)
    while True:
        up = at[at]
        if (up == at).all():
            return at, off
        off += off[at]
        at = up


def _before(keys: Sequence[np.ndarray], nxt: Sequence[np.ndarray], there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each item's predecessor among the given items (-1: none), and of its successor."""
    n = len(there)
    after = np.full(n, -1)
    if there.any():
        after[there] = pd.MultiIndex.from_arrays(keys).get_indexer(pd.MultiIndex.from_arrays([x[there] for x in nxt]))
    before = np.full(n, -1)
    linked = np.flatnonzero(after >= 0)
    before[after[linked]] = linked
    return before, after


def _gather(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else None


def rank(links: DataFrame, keys: Sequence[str], parts: int | None = None, base: int = BASE) -> DataFrame:
    """(keys, position) of the items in ``links``: long key columns, and ``next_<key>`` naming the item after."""
    links = staged(links.select(*[F.col(k).cast("long").alias(f"k{i}") for i, k in enumerate(keys)],
                                *[F.col(f"next_{k}").cast("long").alias(f"n{i}") for i, k in enumerate(keys)]), "links")
    spark, width = links.sparkSession, range(len(keys))
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-links.count() // LOCAL_ITEMS))
    k, n, h = ([f"{x}{i}" for i in width] for x in "knh")

    def contract(batches):
        items = _gather(batches)
        if items is None:
            return
        there = items["n0"].notna().to_numpy()
        cols = [items[c].to_numpy() for c in k]
        before, after = _before(cols, [items[c].fillna(0).to_numpy().astype(np.int64) for c in n], there)
        head, off = _heads(before, np.ones(len(items), np.int64))
        out = items[k].copy()
        for i in width:
            out[f"h{i}"] = cols[i][head]
        out["offset"] = off
        last = np.flatnonzero(after < 0)  # the end of each chain, under its head
        tail = np.full(len(items), -1)
        tail[head[last]] = last
        is_head = tail >= 0
        out["length"] = np.where(is_head, off[tail] + 1, 0)
        for c in n:
            out[c] = items[c].where(there).astype("Int64").iloc[np.where(is_head, tail, 0)].where(is_head).to_numpy(dtype=object, na_value=None)
        yield out

    longs = ", ".join(f"{c} long" for c in [*k, *h, "offset", "length", *n])
    local = staged(links.repartitionByRange(parts, *k).mapInPandas(contract, longs), "chains")
    chains = local.filter("length > 0").select(*k, "length", *n)
    folds = []
    chains = staged(chains, "list")
    while chains.filter("n0 is not null").count() > base:
        chains, removed = _fold(chains, k, n, len(folds))
        folds.append(removed)

    def finish(batches):
        items = _gather(batches)
        if items is None:
            return
        there = items["n0"].notna().to_numpy()
        before, _ = _before([items[c].to_numpy() for c in k], [items[c].fillna(0).to_numpy().astype(np.int64) for c in n], there)
        out = items[k].copy()
        out["position"] = _heads(before, items["length"].to_numpy())[1]
        yield out

    ranked = staged(chains.coalesce(1).mapInPandas(finish, ", ".join(f"{c} long" for c in [*k, "position"])), "ranked")
    for removed in reversed(folds):
        into = ranked.select(*[F.col(c).alias(f"u{c}") for c in k], F.col("position").alias("_at"))
        back = removed.join(into, [removed[f"into{c}"] == into[f"u{c}"] for c in k]).select(*k, (F.col("_at") + F.col("offset")).alias("position"))
        ranked = staged(ranked.union(back), "ranked")
    top = ranked.select(*[F.col(f"k{i}").alias(f"h{i}") for i in width], F.col("position").alias("_at"))
    return local.join(top, h).select(*[F.col(f"k{i}").alias(name) for i, name in enumerate(keys)], (F.col("_at") + F.col("offset")).alias("position"))


def _fold(chains: DataFrame, k: list[str], n: list[str], turn: int) -> tuple[DataFrame, DataFrame]:
    """The list without an independent set of its chains, and those chains with where they went."""
    coin = lambda cols: F.xxhash64(*cols, F.lit(turn)).bitwiseAND(1)
    v = chains.filter(coin(k) == 1).select(*[F.col(c).alias(f"v{c}") for c in [*k, "length", *n]])
    met = [F.col(a) == F.col(f"v{b}") for a, b in zip(n, k)]
    pairs = staged(chains.filter((coin(k) == 0) & F.col(n[0]).isNotNull()).join(v, met, "inner"), "folded")
    removed = pairs.select(*[F.col(f"v{c}").alias(c) for c in k], *[F.col(c).alias(f"into{c}") for c in k], F.col("length").alias("offset"))
    grown = pairs.select(*k, (F.col("length") + F.col("vlength")).alias("length"), *[F.col(f"v{c}").alias(c) for c in n])
    touched = grown.select(*k).union(removed.select(*k))
    return staged(chains.join(touched, k, "left_anti").union(grown), "list"), removed

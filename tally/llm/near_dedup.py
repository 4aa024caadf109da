"""Near-duplicate documents by MinHash bands and odd sketches.

A document is the set of its distinct word shingles. Sixty-four-bit shingle
hashes give MinHash samples; bands of samples are bucket keys. The samples
are also folded into an odd sketch: each (position, sample) toggles one bit,
so the exclusive or of two sketches has a bit for nearly every differing
sample, and its population count bounds and estimates the similarity. Pairs
the sketch rules out are dropped; all others are confirmed on the full sets.

Documents with equal sets are one class from the start, so copies cost
nothing. Buckets chain classes into clusters; each class of a cluster is
shipped once, ordered by set size into blocks of bounded bytes, and pairs of
blocks whose size ranges can hold similar sets are compared inside a task,
which emits only a spanning forest of the confirmed links. So no bucket is
turned into pairs of rows, and a task's memory is bounded, whatever the size
of a group. Links that a forest leaves out join documents already joined.

A band takes as many samples as leave a pair at the threshold a chance below
MISS to share no band (6 at 0.85: (1 - 0.85 ** 6) ** 32; 5 at 0.8), and the
sketch bound is wrong for it with a chance below 1e-8.

Edge cases. Null, empty and word-free texts have an empty set and link with
nothing. Fewer words than a shingle: the whole sequence is the one shingle.
Null ids: the row is its own component, or takes the smallest id it reaches.
Repeated rows and ids are rows of their own. Empty table: empty result. Extra
columns are carried by ``deduplicate`` and ignored by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tally.llm.graph import components
from tally.llm.stage import carried, carried_column, maybe_in, staged
from tally.llm.textual import LOWER, U, binary_column, mix, shingle_hashes, utf8_buffer, word_hashes

#: Parameters: MinHash samples, chance to miss a pair, sketch bits, block size.
SAMPLES = 192
MISS = 1e-6
SKETCH_BITS = 1024
BLOCK_BYTES = 4_000_000

_rng = np.random.default_rng(85)
_MUL = _rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_BAND_MUL = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * U(2) + U(1)


def band_rows(similarity: float) -> int:
    """Samples in a band: the most that miss a pair at the threshold with a chance below MISS."""
    return max([r for r in range(1, 13) if (1 - similarity**r) ** (SAMPLES // r) < MISS], default=1)


def most_differing(similarity: float) -> int:
    """Samples that may differ in a linked pair: six deviations above the mean."""
    mean = SAMPLES * (1 - similarity)
    return int(mean + 6 * (mean * similarity) ** 0.5) + 1


def shingle_sets(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = utf8_buffer(col)
    words, first = word_hashes(LOWER[raw], offsets)
    return shingle_hashes(words, first, width)


def set_keys(vals: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set (of its size and elements), signed; empty sets have 0."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    full = n > 0
    if full.any():
        out[full] = mix(np.add.reduceat(mix(vals ^ U(0xA5A5A5A5A5A5A5A5)), offsets[:-1][full]) + mix(n[full].astype(np.uint64)))
    return out.view(np.int64)


def min_samples(vals: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash samples (sets by SAMPLES) of the non-empty sets; in bounded slices of the values."""
    n_sets = len(offsets) - 1
    out = np.empty((n_sets, SAMPLES), np.uint32)
    short = (vals >> U(32)).astype(np.uint32)
    lo = 0
    while lo < n_sets:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + 50_000, "right")) - 1)
        part, cuts = short[offsets[lo]:offsets[hi]], offsets[lo:hi] - offsets[lo]
        work = np.empty_like(part)
        for j in range(SAMPLES):
            np.multiply(part, _MUL[j], out=work)
            np.add(work, _ADD[j], out=work)
            out[lo:hi, j] = np.minimum.reduceat(work, cuts)
        lo = hi
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (sets by SKETCH_BITS / 8 bytes) of the (position, sample) pairs."""
    at = mix(samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << U(32))) % U(SKETCH_BITS)
    flat = at.astype(np.int64) + np.arange(len(samples))[:, None] * SKETCH_BITS
    bits = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8).reshape(len(samples), SKETCH_BITS), axis=1)


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: doc_id, n_shingles, class_key, bands (bucket keys, none for an empty set)."""
    size = band_rows(percent / 100)
    n_bands = SAMPLES // size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vals, offsets = shingle_sets(batch.column("text"), width)
            n = np.diff(offsets)
            full = np.flatnonzero(n > 0)
            cuts = np.concatenate([offsets[:-1][full], offsets[-1:]])
            keys = np.zeros((0, n_bands), np.uint64)
            if len(full):
                samples = min_samples(vals, cuts)[:, :n_bands * size].reshape(len(full), n_bands, size)
                keys = mix((samples.astype(np.uint64) * _BAND_MUL[:size]).sum(2) + np.arange(n_bands, dtype=np.uint64))
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((n > 0) * n_bands)]).astype(np.int32)),
                                             pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)),
                                              pa.array(set_keys(vals, offsets)), bands], names=["doc_id", "n_shingles", "class_key", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, class_key long, bands array<long>")


def class_sets(docs: DataFrame, width: int) -> DataFrame:
    """Per row: class_key, n, sketch and the sorted shingle hashes (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vals, offsets = shingle_sets(batch.column("text"), width)
            full = np.diff(offsets) > 0
            cuts = np.concatenate([offsets[:-1][full], offsets[-1:]])
            n = np.diff(cuts)
            sketch = odd_sketches(min_samples(vals, cuts)) if full.any() else np.zeros((0, SKETCH_BITS // 8), np.uint8)
            step = np.arange(len(n) + 1) * (SKETCH_BITS // 8)
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(vals, cuts)), pa.array(n.astype(np.int64)),
                                              binary_column(sketch.ravel(), step), binary_column(vals, cuts)],
                                             names=["class_key", "n", "sketch", "hashes"])

    return docs.select("text").mapInArrow(run, "class_key long, n long, sketch binary, hashes binary")


def forest(key: np.ndarray, n: np.ndarray, side: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray],
           percent: int, differing: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between sides 0 and 1 (or within, if all are 0)."""
    order = np.argsort(n, kind="stable")
    parent = list(range(len(key)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    words = np.ascontiguousarray(sketch).view(np.uint64).reshape(len(key), -1)
    across = side.any()
    out = []
    for k, i in enumerate(order.tolist()):
        later = order[k + 1:]
        later = later[:np.searchsorted(n[later], 100 * n[i] // percent, "right")]
        if across:
            later = later[side[later] != side[i]]
        if not len(later):
            continue
        # every differing sample toggles two bits at most
        flips = np.bitwise_count(words[later] ^ words[i]).sum(1)
        for j in later[flips <= 2 * differing].tolist():
            a, b = root(i), root(j)
            if a == b:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[a] = b
                out.append((int(key[i]), int(key[j])))
    return out


def links(docs: DataFrame, sigs: DataFrame, width: int, percent: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b): confirmed links between class keys, enough of them to connect all linked classes."""
    classes = sigs.filter("n_shingles > 0").groupBy("class_key").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"))
    classes = staged(classes, "classes")
    buckets = classes.select("class_key", F.explode("bands").alias("bucket"))
    # a star from each bucket's smallest class keeps all of the bucket in one cluster
    shared = buckets.groupBy("bucket").agg(F.min("class_key").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    star = buckets.join(shared, "bucket").filter("class_key <> hub").select(F.col("class_key").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = components(star)
    # blocks of a cluster: by set size, about block_bytes each
    member = clusters.join(classes.select("class_key", "rep", "n"), F.col("node") == F.col("class_key")).select("class_key", "rep", "n", F.col("root").alias("cluster"))
    member = staged(member, "members")
    # prefix sums of bytes over the cluster's distinct set sizes: a table of sizes, not of members
    sizes = member.groupBy("cluster", "n").agg((F.count(F.lit(1)) * F.col("n") * 8).alias("bytes"), F.count(F.lit(1)).alias("m"))
    run_on = W.partitionBy("cluster").orderBy("n")
    sizes = sizes.withColumn("before", F.sum("bytes").over(run_on) - F.col("bytes")).select(
        F.col("cluster").alias("c"), F.col("n").alias("k"), "before", F.greatest(F.lit(1), F.ceil(F.col("bytes") / block_bytes)).alias("parts"))
    placed = member.join(sizes, (F.col("cluster") == F.col("c")) & (F.col("n") == F.col("k"))).select(
        "class_key", "rep", "n", "cluster",
        # a block is a byte range of the size order; a size too common for one block is dealt over several by key
        F.floor(F.col("before") / block_bytes).alias("range"), F.pmod(F.xxhash64("class_key"), "parts").alias("part"))
    placed = staged(placed, "placed")
    blocks = placed.groupBy("cluster", "range", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one, two = blocks, blocks.select("cluster", *[F.col(x).alias(f"{x}2") for x in ("range", "part", "low", "high")])
    # pairs of blocks of one cluster whose size ranges allow the similarity
    pairs = one.join(two, "cluster").filter("(range, part) <= (range2, part2)").filter(F.col("low2") * percent <= F.col("high") * 100)
    task = F.struct("range", "part", "range2", "part2")
    first = F.struct("range", "part", F.lit(0).alias("side"))
    second = F.struct(F.col("range2").alias("range"), F.col("part2").alias("part"), F.lit(1).alias("side"))
    same = (F.col("range") == F.col("range2")) & (F.col("part") == F.col("part2"))
    sides = pairs.select("cluster", task.alias("task"), F.explode(F.when(same, F.array(first)).otherwise(F.array(first, second))).alias("x"))
    sides = sides.select("cluster", "task", "x.*")
    # block pairs share a Spark group of about two blocks' bytes, so that small clusters cost no call each
    groups = placed.agg(F.ceil(F.sum(F.col("n") * 8) / (2 * block_bytes)).alias("g")).select(F.greatest(F.lit(1), F.coalesce("g", F.lit(1))).alias("g"))
    sides = sides.join(F.broadcast(groups)).withColumn("group", F.pmod(F.xxhash64("cluster", "task"), "g")).drop("g")
    # one text per class, by the class's smallest id; a null id stands for itself
    null_id = -(1 << 63)
    texts = docs.select("text", F.coalesce(F.col("doc_id").cast("long"), F.lit(null_id)).alias("_id"))
    wanted = placed.select(F.coalesce("rep", F.lit(null_id)).alias("_id")).distinct()
    texts = maybe_in(texts, "_id", wanted)[0]  # no other text is shuffled
    found = class_sets(texts.join(wanted, "_id", "left_semi"), width).dropDuplicates(["class_key"])
    # the sets are dealt by class, joined where they lie, and dealt to the groups
    places = placed.join(sides, ["cluster", "range", "part"]).select("group", F.xxhash64("cluster", "task").alias("unit"), "side", "class_key", "n")
    work = places.join(found.drop("n"), "class_key").select("group", "unit", "side", "class_key", "n", "sketch", "hashes")
    differing = most_differing(percent / 100)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["unit", "n", "class_key"], kind="stable")
        unit, key, n, side = (pdf[c].to_numpy() for c in ("unit", "class_key", "n", "side"))
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
        cuts = np.concatenate([np.flatnonzero(np.diff(unit, prepend=unit[0] - 1)), [len(unit)]])
        found = [e for a, b in zip(cuts[:-1], cuts[1:]) for e in forest(key[a:b], n[a:b], side[a:b], sketch[a:b], sets[a:b], percent, differing)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return work.groupBy("group").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    sigs = staged(signatures(docs, width, percent), "signatures")
    found = staged(links(docs, sigs, width, percent), "links")
    roots = components(found)
    rows = sigs.select("doc_id", "n_shingles", "class_key").join(roots, F.col("class_key") == F.col("node"), "left")
    rows = rows.withColumn("root", F.coalesce("root", "class_key"))
    lowest = rows.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("low"))
    rows = rows.join(lowest.withColumnRenamed("root", "r"), (F.col("root") == F.col("r")) & (F.col("n_shingles") > 0), "left")
    component = F.coalesce("low", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, all columns: the smallest doc_id's (null last).

    Rows are told apart by their id and whole text, so repeated rows, null ids and ids that
    two texts share are groups like any other. Of rows equal in both one stays; a text
    without words is linked with no other.
    """
    doc_id, text = carried_column(docs, "doc_id").cast("long"), carried_column(docs, "text")
    keyed = carried(docs).select("*", F.xxhash64(doc_id, text).alias("_row"))
    keys = staged(keyed.select("_row", doc_id.alias("_id"), F.xxhash64(F.lit(1), text, doc_id).alias("_check"))
                  .groupBy("_row", "_id", "_check").agg(F.count(F.lit(1)).alias("_copies")), "row-keys")
    if not keys.groupBy("_row").count().filter("count > 1").isEmpty():
        # two rows under one key: number the rows instead, which takes a copy of the texts
        keyed = staged(carried(docs).select("*", F.monotonically_increasing_id().alias("_row")), "numbered")
        keys = keyed.select("_row", doc_id.alias("_id"), F.lit(1).alias("_copies"))
    rows = keyed.select(F.col("_row").alias("doc_id"), text.alias("text"))
    found = near_duplicates(rows, width, percent).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")).distinct()
    keep = keys.join(found, "_row").groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row", "_copies")).alias("_best"))
    keep = staged(keep.select("_best._row", "_best._copies"), "kept-rows")
    single, repeated = (keep.filter(x).select("_row") for x in ("_copies = 1", "_copies > 1"))
    # every row is under one of the keys, so one that is not under the others stays; the rest are joined
    others = staged(keys.select("_row").join(single, "_row", "left_anti"), "other-rows")
    unsure, sure = maybe_in(keyed, "_row", others)
    out = sure.unionByName(unsure.join(single, "_row", "left_semi"))
    if not repeated.isEmpty():
        out = out.unionByName(unsure.join(repeated, "_row", "left_semi").dropDuplicates(["_row"]))
    return out.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(docs.columns)])

"""Repeated byte passages by a distributed merge sort of suffix runs.

Removes every byte that lies in a string of ``length`` bytes which also
starts anywhere else, in the same text or another.

Sparse suffixes. The string that starts at s is represented by its anchor: the
leftmost smallest hash of eight bytes among the first ``WINDOW`` places. Equal
strings have equal anchors at equal distance, so only the suffixes at anchors
need sorting, and an anchor a stands for a run of starts [lo, hi]. All strings
of one anchor share the ``length - WINDOW + 1`` bytes from a on: equal strings
lie in one class, the anchors with equal bytes there.

Most anchors are settled by counts of hashes: alone in its class, nothing
repeats; another anchor with all the same bytes [lo, hi + length), everything
does. One suffix of each different kind in the classes left is sorted: tasks
emit front-coded sorted runs (length of the prefix shared with the record
before, then the rest), a run per class partition; a loser tree merges the runs
and compares strings only beyond the prefix they are known to share, so the
merge yields the common prefix lengths of neighbours. From these and the
common lengths to the left of the anchors follow the repeated starts of each
suffix: equal left bytes and a shared prefix that make up ``length`` together.

Scale. Counts are combined before the shuffle, joins are left to skew-join
handling. A class of more than ``HOT_CLASS`` kinds (a passage in very many
different surroundings) is not merged in one task; its strings are compared by
hash, spread over all tasks. Nothing is capped.

Edge cases. Null and empty text: no bytes. Texts shorter than ``length``: kept.
Repeated rows repeat each other. Null or repeated ids: rows are told apart by
id and text together. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tally.llm.stage import staged
from tally.llm.textual import BASE, BASE_INV, BYTE_CODE, U, mix, powers, utf8_buffer

#: Parameters: places searched for an anchor, bytes of its hash, kinds of suffix merged in one task, suffixes a partition.
WINDOW, GRAM = 200, 8
HOT_CLASS = 20_000
PARTITION_SUFFIXES = 40_000
PAIRWISE = 12
PIECE_BYTES = 1 << 20


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i; x is padded by its largest value."""
    n = len(x)
    m = -(-(n + w) // w) * w
    padded = np.full(m, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:n + w - 1])


def piece_anchors(x: np.ndarray, ends: np.ndarray, length: int, pw: np.ndarray, inv: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of texts that lie end to end in ``x``: (a, lo, hi, class hash, kind hash), positions in x."""
    n = len(x)
    padded = np.concatenate([x, np.zeros(GRAM, np.uint8)])
    gram = np.ndarray((n,), "<u8", padded, strides=(1,)).astype(np.uint64)
    end_of = np.repeat(ends, np.diff(ends, prepend=0))
    at = np.arange(n)
    key = (mix(gram) >> U(32) << U(32)) | at.astype(np.uint64)
    key[at + GRAM > end_of] = np.iinfo(np.uint64).max
    start = np.flatnonzero(at + length <= end_of)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    anchor = (sliding_min(key, WINDOW)[start] & U(0xFFFFFFFF)).astype(np.int64)
    first = np.ones(len(start), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    lo = start[first]
    hi = start[np.append(np.flatnonzero(first)[1:] - 1, len(start) - 1)]
    a = anchor[first]
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[x] * pw[:n], out=acc[1:])
    shared = length - WINDOW + 1
    h = mix((acc[a + shared] - acc[a]) * inv[a])
    f = mix((acc[hi + length] - acc[lo]) * inv[lo] + mix(((a - lo) << 20 | (hi - lo)).astype(np.uint64)))
    return a, lo, hi, h.view(np.int64), f.view(np.int64)


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(h, f, row_key, a, lo, hi) of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw, inv = powers(BASE, 2 * PIECE_BYTES), powers(BASE_INV, 2 * PIECE_BYTES)
        for batch in batches:
            raw, offsets = utf8_buffer(batch.column("text"))
            keys = batch.column("row_key").to_numpy()
            i = 0
            while i < len(keys):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1)
                x = raw[offsets[i]:offsets[j]]
                if len(x) > len(pw):
                    pw, inv = powers(BASE, len(x) + 1), powers(BASE_INV, len(x) + 1)
                ends = offsets[i + 1:j + 1] - offsets[i]
                a, lo, hi, h, f = piece_anchors(x, ends, length, pw, inv)
                own = np.searchsorted(ends, lo, "right")
                base = np.concatenate([[0], ends])[own]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(f), pa.array(keys[i:j][own]), *[pa.array((v - base).astype(np.int32)) for v in (a, lo, hi)]],
                                                 names=["h", "f", "row_key", "a", "lo", "hi"])
                i = j

    return docs.select("text", "row_key").mapInArrow(run, "h long, f long, row_key long, a int, lo int, hi int")


# --- front-coded runs and their merge ----------------------------------------

def common_prefix(a: bytes, b: bytes, k: int) -> int:
    """Length of the common prefix, known to be at least ``k``."""
    n = min(len(a), len(b))
    while k < n:
        x, y = a[k:k + 64], b[k:k + 64]
        if x != y:
            m = min(len(x), len(y))
            d = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
            return k + m - (d.bit_length() + 7) // 8
        k += len(x)
    return min(k, n)


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, bytes]:
    """(lengths of the prefix shared with the one before, rests end to end) of sorted suffixes."""
    shared, rests, before = [], [], b""
    for s in suffixes:
        k = common_prefix(before, s, 0)
        shared.append(k)
        rests.append(s[k:])
        before = s
    return np.array(shared, np.int32), b"".join(rests)


class Run:
    """Reader of a front-coded run: the current suffix, and its prefix shared with the one before."""

    def __init__(self, shared: np.ndarray, sizes: np.ndarray, rests: bytes):
        self.shared, self.sizes, self.rests = shared.tolist(), sizes.tolist(), rests
        self.i, self.at, self.suffix = -1, 0, b""
        self.step()

    def step(self) -> int | None:
        """Advance; the prefix shared with the suffix before, or None at the end."""
        self.i += 1
        if self.i == len(self.shared):
            return None
        k = self.shared[self.i]
        n = self.sizes[self.i] - k
        self.suffix = self.suffix[:k] + self.rests[self.at:self.at + n]
        self.at += n
        return k


def merge(runs: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, index in run, suffix, prefix shared with the suffix put out before), in order.

    A loser tree whose players carry the prefix they share with the last suffix
    put out. Of two, the one that shares more is the smaller; only if both share
    as much are bytes compared, from there on, and the loser keeps what it
    shares with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    known: list[int | None] = [0 if r < len(runs) and runs[r].shared else None for r in range(k)]
    tree = [-1] * k

    def game(a: int, b: int) -> tuple[int, int]:
        x, y = known[a], known[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if x != y:
            return (a, b) if x > y else (b, a)
        s, t = runs[a].suffix, runs[b].suffix
        c = common_prefix(s, t, x)
        first, second = ((a, b) if (s[c:c + 1], a) < (t[c:c + 1], b) else (b, a))
        known[second] = c
        return first, second

    def play(node: int) -> int:
        if node >= k:
            return node - k
        winner, tree[node] = game(play(2 * node), play(2 * node + 1))
        return winner

    winner = play(1)
    while known[winner] is not None:
        run = runs[winner]
        yield winner, run.i, run.suffix, known[winner]
        known[winner] = run.step()
        node = (winner + k) // 2
        while node:
            winner, tree[node] = game(winner, tree[node])
            node //= 2


def repeated_starts(suffixes: list[bytes], lefts: list[bytes], shared: list[int], low: list[int], high: list[int], length: int) -> list[np.ndarray]:
    """For each suffix of a class, in sorted order, the distances j before its anchor at which a
    repeated string starts; j runs from low to high, ``shared[i]`` is the prefix shared by i - 1 and i."""
    m = len(lefts)
    out = [np.zeros(high[i] + 1, bool) for i in range(m)]
    if m <= PAIRWISE:
        for i in range(m):
            right = 1 << 30
            for k in range(i + 1, m):
                right = min(right, shared[k])
                left = common_prefix(lefts[i], lefts[k], 0)
                a, b = max(length - right, low[i], low[k], 0), min(left, high[i], high[k])
                if a <= b:
                    out[i][a:b + 1] = out[k][a:b + 1] = True
        return out
    # in the order of the left bytes, too, those that share j of them are neighbours
    order = sorted(range(m), key=lefts.__getitem__)
    alike = np.array([0] + [common_prefix(lefts[a], lefts[b], 0) for a, b in zip(order[:-1], order[1:])])
    shared_at, lo, hi = np.array(shared), np.array(low), np.array(high)
    left = np.empty(m, np.int64)
    for j in range(max(high) + 1):
        right = np.cumsum(np.concatenate([[False], shared_at[1:] < length - j]))
        left[order] = np.cumsum(alike < j)
        able = np.flatnonzero((lo <= j) & (j <= hi))
        _, back, n = np.unique(left[able] * m + right[able], return_inverse=True, return_counts=True)
        for i in able[n[back] > 1].tolist():
            out[i][j] = True
    return out


def runs_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [first, last] of true entries."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def suffix_runs(texts: DataFrame, partitions: int, length: int) -> DataFrame:
    """A front-coded sorted run per task batch and class partition, from texts with their suffix lists
    (wanted: array of (h, n, a, lo, hi))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_buffer(batch.column("text"))
            by_part: dict[int, list[tuple]] = {}
            for i, (key, wanted) in enumerate(zip(batch.column("row_key").to_pylist(), batch.column("wanted").to_pylist())):
                text = raw[offsets[i]:offsets[i + 1]].tobytes()
                for w in wanted:
                    a, lo, hi = w["a"], w["lo"], w["hi"]
                    by_part.setdefault(w["h"] % partitions, []).append((text[a:hi + length], text[lo:a][::-1], key, w["n"], a, lo, hi))
            rows = []
            for part, records in by_part.items():
                records.sort()
                shared, rests = front_code([r[0] for r in records])
                rows.append({"part": part, "shared": shared.tobytes(), "sizes": np.array([len(r[0]) for r in records], np.int32).tobytes(),
                             "rests": pa.compress(rests, codec="lz4_raw", asbytes=True), "rest_size": len(rests),
                             "lefts": pa.compress(b"".join(r[1] for r in records) or b"\0", codec="lz4_raw", asbytes=True),
                             "keys": np.array([r[2:] for r in records], np.int64).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=_RUN)

    return texts.select("row_key", "text", "wanted").mapInArrow(
        run, "part long, shared binary, sizes binary, rests binary, rest_size long, lefts binary, keys binary")


_RUN = pa.schema([("part", pa.int64()), ("shared", pa.binary()), ("sizes", pa.binary()), ("rests", pa.binary()), ("rest_size", pa.int64()), ("lefts", pa.binary()), ("keys", pa.binary())])


def merged_spans(key: tuple, pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Merge a partition's runs and settle its classes: (row_key, start, end) of repeated strings."""
    runs, keys, lefts = [], [], []
    for r in pdf.itertuples():
        sizes = np.frombuffer(r.sizes, np.int32)
        runs.append(Run(np.frombuffer(r.shared, np.int32), sizes, pa.decompress(r.rests, r.rest_size, codec="lz4_raw", asbytes=True)))
        k = np.frombuffer(r.keys, np.int64).reshape(-1, 5)
        keys.append(k)
        n = k[:, 2] - k[:, 3]
        data = pa.decompress(r.lefts, max(1, int(n.sum())), codec="lz4_raw", asbytes=True)
        cuts = np.concatenate([[0], np.cumsum(n)]).tolist()
        lefts.append([data[a:b] for a, b in zip(cuts[:-1], cuts[1:])])
    found: list[tuple[int, int, int]] = []
    group: list[tuple[int, int, bytes, int]] = []
    least = length - WINDOW + 1

    def settle() -> None:
        if len(group) < 2:
            return
        rec = [keys[r][i] for r, i, _, _ in group]
        low, high = [int(k[2] - k[4]) for k in rec], [int(k[2] - k[3]) for k in rec]
        marks = repeated_starts([g[2] for g in group], [lefts[r][i] for r, i, _, _ in group], [g[3] for g in group], low, high, length)
        for k, mark in zip(rec, marks):
            if k[1] == 1:
                found.extend((int(k[0]), int(k[2]) - b, int(k[2]) - a + length) for a, b in runs_of(mark))

    for item in merge(runs):
        if group and item[3] < least:
            settle()
            group.clear()
        group.append(item)
    settle()
    return pd.DataFrame(found, columns=["row_key", "start", "end"], dtype="int64")


def hashed_spans(texts: DataFrame, length: int) -> DataFrame:
    """The same for suffixes of very large classes: all their strings by hash, counted over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_buffer(batch.column("text"))
            for i, (key, wanted) in enumerate(zip(batch.column("row_key").to_pylist(), batch.column("wanted").to_pylist())):
                x = raw[offsets[i]:offsets[i + 1]]
                acc = np.zeros(len(x) + 1, np.uint64)
                np.cumsum(BYTE_CODE[x] * powers(BASE, len(x) + 1)[:-1], out=acc[1:])
                inv = powers(BASE_INV, len(x) + 1)
                s = np.concatenate([np.arange(w["lo"], w["hi"] + 1) for w in wanted])
                n = np.concatenate([np.full(w["hi"] - w["lo"] + 1, w["n"]) for w in wanted])
                string = mix((acc[s + length] - acc[s]) * inv[s])
                yield pa.RecordBatch.from_arrays([pa.array(string.view(np.int64)), pa.array(np.full(len(s), key)), pa.array(s), pa.array(n)],
                                                 names=["string", "row_key", "start", "n"])

    strings = staged(texts.select("row_key", "text", "wanted").mapInArrow(run, "string long, row_key long, start long, n long"), "strings")
    again = strings.groupBy("string").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return strings.filter("n = 1").join(again, "string", "left_semi").select("row_key", "start", (F.col("start") + length).alias("end"))


def repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    has_repeat, and the kept bytes as text, without characters of which only some bytes are left."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("doc_id", "text"))
    long_rows = rows.filter(F.octet_length("text") >= length)
    marks = staged(anchors(long_rows, length), "anchors")
    kinds = marks.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "a", "lo", "hi")).alias("one"))
    kinds = staged(kinds.withColumn("single", (F.col("n") == 1).cast("int")), "kinds")
    classes = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.max("single").alias("open"))
    # everything repeats where all bytes of the anchor's strings are found again
    whole = marks.join(kinds.filter("n > 1").select("h", "f"), ["h", "f"], "left_semi").select(
        "row_key", F.col("lo").cast("long").alias("start"), (F.col("hi") + length).cast("long").alias("end"))
    unsettled = staged(kinds.join(classes.filter("kinds > 1 and open = 1"), "h").select(
        F.col("one.row_key").alias("row_key"), F.struct("h", "n", "one.a", "one.lo", "one.hi").alias("w"), "kinds"), "unsettled")
    wanted = unsettled.groupBy("row_key").agg(F.collect_list(F.when(F.col("kinds") <= HOT_CLASS, F.col("w"))).alias("wanted"),
                                              F.collect_list(F.when(F.col("kinds") > HOT_CLASS, F.col("w"))).alias("hot"))
    once = long_rows.select("row_key", "text").join(wanted, "row_key").dropDuplicates(["row_key"])
    texts = staged(once, "suffix-texts")
    n = unsettled.count()
    parts = max(1, n // PARTITION_SUFFIXES, 8)
    sorted_runs = suffix_runs(texts.filter("size(wanted) > 0"), parts, length)
    merged = sorted_runs.groupBy("part").applyInPandas(lambda key, pdf: merged_spans(key, pdf, length), "row_key long, start long, end long")
    spans = whole.union(merged)
    hot = texts.filter("size(hot) > 0").select("row_key", "text", F.col("hot").alias("wanted"))
    spans = spans.union(hashed_spans(hot, length))
    per_row = spans.groupBy("row_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return strip(rows.join(per_row, "row_key", "left")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeat"), "text")


def strip(rows: DataFrame) -> DataFrame:
    """Remove the spans (array of (start, end)) from each text's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_buffer(batch.column("text"))
            out = []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = raw[offsets[i]:offsets[i + 1]]
                gone, n_spans, pieces, at = 0, 0, [], 0
                end = -1
                for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                    if s > end:
                        n_spans += 1
                        pieces.append(text[at:s])
                        gone += e - s
                        at = end = e
                    elif e > end:
                        gone += e - end
                        at = end = e
                kept = b"".join([*pieces, text[at:]])
                out.append((len(text), gone, n_spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            cols = list(zip(*out)) if out else [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]], *[pa.array(c, pa.string()) for c in cols[3:]]],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    return rows.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")

"""Periodic runs of words by suffix automaton and path recolouring.

A run is a stretch of words with smallest period q and at least max(6, 4 q) words
that no neighbouring word extends. Per text:

1. the suffix automaton of the words; its suffix links are a tree in which the
   path of prefix i holds all substrings that end at word i, longest first;
2. each appended word i recolours the path of its prefix with i, as a link-cut
   tree's access does. The path falls into heavy paths, each with a stack of segments
   of one colour; a recolouring replaces a stack's top segments, so all of them together
   cost n log n. Every replaced segment says that its longest substring, L words, ended
   at e before: words i-L+1.. i repeat at distance p = i - e. From L >= 3 p on this is a
   stretch of period p and length L + p. As L is the longest common suffix of the
   two prefixes, its start is the run's start; the last i with the same start and
   period is the run's end; p is the smallest period, since a smaller one would have given
   the segment a later colour.

Only windows that can hold a run go through this: in a run every three-word window but
the first q recurs within q words, so blocks of such windows, long enough for
their distances, enclose it. The blocks come from numpy on many texts at once (by hash,
which can only add windows); words are compared exactly inside.

Scale. No shuffle: a task works through its texts in slices of ``SLICE_BYTES``. A
text is held whole, and a window takes about 700 bytes a word while it is worked on.

Edge cases. Null or empty text: no words, no runs, empty collapsed text. Null id:
kept, with the text as it is. Repeated rows: each on its own. Empty table: empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tally.llm.textual import U, mix, span_hashes, utf8_buffer, word_spans

#: Parameters: least words of a run, least periods in it, bytes worked on at once.
MIN_WORDS, MIN_PERIODS = 6, 4
SLICE_BYTES = 1 << 22


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest substring of each state of the suffix automaton, and each prefix's state."""
    moves: list[dict[int, int]] = [{}]
    link, longest, ends, last = [-1], [0], [], 0
    for n, word in enumerate(words, 1):
        state = len(link)
        moves.append({})
        longest.append(n)
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = state
            at = link[at]
        if at < 0:
            link.append(0)
        else:
            to = moves[at][word]
            if longest[to] == longest[at] + 1:
                link.append(to)
            else:
                twin = state + 1
                link.append(twin)
                moves.append(moves[to].copy())
                longest.append(longest[at] + 1)
                link.append(link[to])
                link[to] = twin
                while at >= 0 and moves[at].get(word) == to:
                    moves[at][word] = twin
                    at = link[at]
        last = state
        ends.append(state)
    return link, longest, ends


def _heavy_tops(link: list[int], longest: list[int]) -> list[int]:
    """The top state of each state's heavy path in the suffix-link tree."""
    order = np.argsort(np.array(longest), kind="stable")[:0:-1].tolist()  # without the root; children first
    size, heaviest, heavy = [1] * len(link), [0] * len(link), [0] * len(link)
    for v in order:
        s, p = size[v], link[v]
        size[p] += s
        if s > heaviest[p]:
            heaviest[p], heavy[p] = s, v
    top = list(range(len(link)))
    for v in reversed(order):
        p = link[v]
        if heavy[p] == v:
            top[v] = top[p]
    return top


def window_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word sequence, by start, then period."""
    link, longest, ends = automaton(words)
    top = _heavy_tops(link, longest)
    depths: dict[int, list[int]] = {}
    colours: dict[int, list[int]] = {}
    found: dict[tuple[int, int], int] = {}
    least = MIN_PERIODS - 1
    for i, v in enumerate(ends):
        before = -1
        while v > 0:
            head, deep = top[v], longest[v]
            depth = depths.get(head)
            if depth is None:
                depths[head], colours[head] = [deep], [i]
            else:
                colour = colours[head]
                while depth and depth[-1] <= deep:  # segments that the path replaces
                    length, e = depth.pop(), colour.pop()
                    if e != before and length >= least * (i - e) and length + i - e >= MIN_WORDS:
                        found[(i - length - (i - e) + 1, i - e)] = i
                    before = e
                if depth:  # the upper part of a segment that goes on below
                    e = colour[-1]
                    if e != before and deep >= least * (i - e) and deep + i - e >= MIN_WORDS:
                        found[(i - deep - (i - e) + 1, i - e)] = i
                    before = e
                depth.append(deep)
                colour.append(i)
            v = link[head]
    return sorted((start, end - start + 1, period) for (start, period), end in found.items())


def windows(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Disjoint (start, end) of words, end exclusive, outside of which no text has a run."""
    n = len(hashes)
    if n < MIN_WORDS:
        return np.zeros((0, 2), np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    gram = mix(hashes[:-2] + hashes[1:-1] * U(0x9E3779B97F4A7C15) + hashes[2:] * U(0xC2B2AE3D27D4EB4F) + mix(text[:-2].astype(np.uint64) + U(1)))
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    distance = np.full(n, n, np.int64)
    distance[order[1:][same]] = (order[1:] - order[:-1])[same]
    distance[:-2][text[:-2] != text[2:]] = n
    marked = distance < n
    while True:
        edge = np.diff(np.r_[0, marked.astype(np.int8), 0])
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        reach = (hi - lo + 2) // 3  # the largest period that a block allows
        reach[hi - lo < 3] = 0
        limit = np.zeros(n, np.int64)
        limit[marked] = np.repeat(reach, hi - lo)
        keep = marked & (distance <= limit)
        if (keep == marked).all():
            break
        marked = keep
    lo, hi = np.maximum(lo - reach, first[text[lo]]) if len(lo) else lo, hi + 2
    if not len(lo):
        return np.zeros((0, 2), np.int64)
    new = np.r_[True, (lo[1:] >= np.maximum.accumulate(hi)[:-1])]
    return np.stack([np.minimum.reduceat(lo, np.flatnonzero(new)), np.maximum.reduceat(hi, np.flatnonzero(new))], 1)


Layout = Callable[[int, int], "tuple[int, int] | None"]


def _texts(ids: list, col: pa.Array, layout: Layout | None):
    """(runs, collapsed bytes) of each text of an Arrow column."""
    raw, offsets = utf8_buffer(col)
    lo = 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        part, at = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        start, end, first = word_spans(part, at)
        source = np.arange(len(start))
        changed = set()
        for k in range(hi - lo) if layout else ():
            n = int(first[k + 1] - first[k])
            if n and ids[lo + k] is not None and (ap := layout(ids[lo + k], n)):
                a, p = ap
                source[first[k] + a:first[k + 1]] = first[k] + a + np.arange(n - a) % p
                changed.add(k)
        wide = windows(span_hashes(part, start, end)[source], first)
        data, owner = part.tobytes(), np.searchsorted(first, wide[:, 0], "right") - 1
        runs: dict[int, list] = {}
        for (a, b), k in zip(wide.tolist(), owner.tolist()):
            names: dict[bytes, int] = {}
            src = source[a:b]
            words = [names.setdefault(data[s:e], len(names)) for s, e in zip(start[src].tolist(), end[src].tolist())]
            base = a - int(first[k])
            runs.setdefault(k, []).extend((s + base, n, q) for s, n, q in window_runs(words))
        for k in range(hi - lo):
            mine, text = runs.get(k, []), data[at[k]:at[k + 1]]
            if k in changed or mine:
                keep = np.ones(first[k + 1] - first[k], bool)
                for s, n, q in mine:
                    keep[s + q:s + n] = False
                src = source[first[k]:first[k + 1]][keep]
                yield mine, b" ".join([data[s:e] for s, e in zip(start[src].tolist(), end[src].tolist())])
            else:
                yield mine, b" ".join(text.split())
        lo = hi


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text", layout: Layout | None = None) -> DataFrame:
    """One row per document: the id, ``runs`` (array of start, length, period, by start, then period) and
    ``collapsed``, the text's words without those that repeat a run's first period, joined by one space.

    ``layout`` may give (a, p) for an id and a number of words: then word i >= a is
    read as word a + (i - a) % p of the text.
    """
    element = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def work(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            out, size, lo = [], 0, 0
            for k, (found, rest) in enumerate(_texts(ids, b.column(1), layout), 1):
                out.append((found, rest))
                size += len(rest)
                if size >= SLICE_BYTES or k == len(ids):
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).slice(lo, len(out)),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x, _ in out], pa.list_(element)),
                        pa.array([x.decode() for _, x in out], pa.string())], names=["id", "runs", "collapsed"])
                    out, size, lo = [], 0, k

    read = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return read.mapInArrow(work, "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string").withColumnRenamed("id", id)


def planted(doc_id: int, n: int) -> tuple[int, int] | None:
    """The contract's layout: about a tenth of the documents repeat a stretch of their words."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Figures of each document's longest run (ties: smallest start, then period) and digests of its runs and collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.select(
        id, F.size("runs").cast("long").alias("n_runs"), (-longest["start"]).alias("start"), longest["length"].alias("length"), (-longest["period"]).alias("period"),
        F.floor(1000 * longest["length"] / -longest["period"]).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

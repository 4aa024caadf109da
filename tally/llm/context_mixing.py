"""Text probability by logistic mixing of hashed-context bit predictors.

A text is coded as its words, each spelled byte by byte with a terminator, and
an end symbol (an empty word). Every bit is predicted by several contexts: the
place in the word, the last byte, the last two, the last four, and the whole
prefix of the word. A context and the bits of the byte so far hash to a slot
with the counts of zeros and ones seen there. The predictions, stretched to
logits, are combined by weights that a gate picks (how much of the prefix has
been seen, and the place); an adaptive table then refines the mixed
probability by the bits so far. Weights and table learn online, each bit
scored before it is learnt from, and without a word's own occurrence.

That spelling model does not look beyond the word, so each distinct word is
spelled once. Contexts that span words are mixed in above it: the word after
the previous one, and after the previous two, by their counts in all training
texts (a text begins with two start symbols). A gate, the size of the
context's count, picks how much of the longer context goes into the
probability; a context never seen gives all to the shorter one. The shares are
fitted on all training tokens, each without its own occurrence. Every step is
a mean of proper distributions, so the probability is proper, and a text is
coded in its order. The model is frozen for scoring: it does not learn from
the text it scores.

Flow. Tasks turn texts into word indices of a chunk and the chunk's distinct
words; distinct words go to shards by hash (a common word is one entry of a
chunk, so no shard gets hot), once; a shard adds up counts over all training
texts, keeps each word's spelling once with the places of the chunks' entries,
codes its words and answers each chunk; chunks, bucketed by their number, stay
where they are and add up their texts. Count tables have a fixed size, summed
block by block. The mixer learns from every training word by its count: groups
of shards each make an online pass over theirs, in rounds, and their mixers are
averaged. Word pairs and triples go to shards whose number follows the
tokens, one entry a chunk, as sorted keys whose bits follow the tokens too:
their counts are exact but for hash collisions, one key in 2^SPARE_BITS at
every size. Only the tables, the totals, counts by gate and ratio, and the
groups' mixers (numbers of fixed size each) reach the driver.

Edge cases. Null and empty texts: the end symbol alone. A null id counts as
training. Repeated rows are each counted and scored. Without training texts
counts are zero and the untrained model still gives a proper probability.
Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tally.llm.stage import fold, staged, staged_by
from tally.llm.textual import LOWER, U, mix, span_hashes, utf8_buffer, word_spans

#: Parameters: slots per context (log2), shards, entries a shard handles at once; the mixer learns from all training
#: words, in groups of about GROUP_WORDS, lots of LOT_WORDS at a time, in ROUNDS parts with the groups' mixers averaged after each.
SLOT_BITS = {"place": 12, "one": 16, "two": 20, "four": 20, "prefix": 22}
SHARD_BITS = 6
SHARD_ENTRIES = 1_500_000
CHUNK_TOKENS = 2_000_000
GROUP_WORDS = 200_000
LOT_WORDS = 8192
ROUNDS = 2
PACK_LEVEL = 5
SLICE_TOKENS = 1 << 18
RATE = 0.02
APM_PRIOR = 64.0

ORDERS = list(SLOT_BITS)
SLOT_BASE = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS.values()])])
N_SLOTS = int(SLOT_BASE[-1])
BLOCK = 1 << 17
GATE_STEPS = 8
N_GATES = 6 * GATE_STEPS
APM_STEPS = 33
END_KEY = U(0)
#: Contexts that span words: key before a text's first word, gates (log2 of the context's count), shares tried.
START_KEY = U(0x5354415254)
SPAN_GATES = 48
SHARES = np.linspace(0, 0.98, 25)
#: Bits of a span key beyond log2 of their number (chance of a collision 2^-SPARE_BITS at every size), bits of a word's key in it.
SPARE_BITS = 12
WORD_KEY_BITS = 48
#: Histogram of seen / mixed for the fit: steps an octave, octaves each way.
RATIO_STEPS, RATIO_OCTAVES = 16, 32


# --- the model --------------------------------------------------------------

class Spelling:
    """Distinct words laid out for lockstep coding: step t is byte t of every word that has one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = np.diff(offsets)
        self.order = np.argsort(-n, kind="stable")       # long words first: a step is a prefix of the order
        self.start, self.length = offsets[:-1][self.order], n[self.order]
        self.data = data

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
        """(words as positions in ``order``, their byte or terminator, contexts) for each step."""
        m = len(self.length)
        prefix = np.zeros(m, np.uint64)
        last = np.zeros(m, np.uint64)
        t = 0
        while m:
            has = self.length[:m] > t
            byte = np.full(m, 32, np.uint64)
            byte[has] = self.data[(self.start[:m] + t)[has]]
            yield np.arange(m), byte, {
                "place": np.full(m, min(t, 15), np.uint64), "one": last[:m] & U(0xFF), "two": last[:m] & U(0xFFFF),
                "four": last[:m] & U(0xFFFFFFFF), "prefix": prefix[:m] + U(min(t, 255))}
            prefix[:m] = mix(prefix[:m] + byte + U(0x9E37))
            last[:m] = (last[:m] << U(8)) | byte
            t += 1
            m = int(np.searchsorted(-self.length[:m], -t, "right"))  # words of length t still have their terminator


def slots(context: dict[str, np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Slot of each order for the bit after ``node`` (the bits so far with a leading one)."""
    out = []
    for k, (name, bits) in enumerate(SLOT_BITS.items()):
        c = context[name]
        small = bits <= 16
        h = (c << U(8)) + node if small else mix(c * U(0x9E3779B97F4A7C15) + node + U(k << 56))
        out.append((h & U((1 << bits) - 1)).astype(np.int64) + SLOT_BASE[k])
    return out


def add_bits(flat: np.ndarray, data: np.ndarray, offsets: np.ndarray, weight: np.ndarray) -> None:
    """Add to the slots' counts (2 * N_SLOTS, zeros and ones by turns) those of words with the given weights."""
    spelling = Spelling(data, offsets)
    weight = weight[spelling.order].astype(float)
    for at, byte, context in spelling.steps():
        node = np.ones(len(at), np.uint64)
        for k in range(7, -1, -1):
            bit = (byte >> U(k)) & U(1)
            for s in slots(context, node):
                np.add.at(flat, 2 * s + bit.astype(np.int64), weight[at])
            node = (node << U(1)) | bit


def count_bits(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Counts (N_SLOTS, 2) of words with the given weights."""
    flat = np.zeros(2 * N_SLOTS)
    add_bits(flat, data, offsets, weight)
    return flat.reshape(-1, 2).astype(np.float32)


class Mixer:
    """Gated weights and the refining table, whose cells are means of the bits seen there."""

    def __init__(self, kind: type = np.float64) -> None:
        self.weights = np.zeros((N_GATES, 2 * len(ORDERS)), kind)
        self.weights[:, :len(ORDERS)] = 0.25
        grid = np.linspace(-8, 8, APM_STEPS)
        self.start = np.tile(1 / (1 + np.exp(-grid)), (256, 1))
        self.bits = np.zeros((2, 256 * APM_STEPS))  # tokens, and tokens whose bit is one
        self.squares = np.zeros(self.weights.shape)
        self.refresh()

    def refresh(self) -> None:
        seen, ones = self.bits.reshape(2, 256, APM_STEPS)
        self.apm = np.clip((APM_PRIOR * self.start + ones) / (APM_PRIOR + seen), 1e-6, 1 - 1e-6).astype(self.weights.dtype)

    def predict(self, stretch: np.ndarray, sure: np.ndarray, seen: np.ndarray, place: int, node: np.ndarray) -> tuple[np.ndarray, ...]:
        """stretch, sure: (orders, words); seen: step of the prefix's count. Returns p(bit = 1) and what learning needs."""
        x = np.concatenate([stretch, stretch * sure])
        gate = min(place, 5) * GATE_STEPS + seen.astype(np.int64)
        dot = np.clip(np.einsum("ij,ji->i", self.weights.take(gate, axis=0), x), -12, 12)
        p = 1 / (1 + np.exp(-dot))
        where = np.clip((dot + 8) * ((APM_STEPS - 1) / 16), 0, APM_STEPS - 1.001)
        low = where.astype(np.int64)
        part = where - low
        cell = node.astype(np.int64) * APM_STEPS + low
        apm = self.apm.ravel()
        refined = apm[cell] * (1 - part) + apm[cell + 1] * part
        return np.clip(0.6 * p + 0.4 * refined, 2e-7, 1 - 2e-7), p, x, gate, cell, part

    def learn(self, bit: np.ndarray, weight: np.ndarray, state: tuple[np.ndarray, ...]) -> None:
        """One step along the gates' mean gradients, each weight at its own pace (AdaGrad)."""
        _, p, x, gate, cell, part = state
        error = (bit - p) * weight
        tokens = np.bincount(gate, weight, N_GATES)
        step = np.stack([np.bincount(gate, error * v, N_GATES) for v in x], 1) / np.maximum(tokens, 32.0)[:, None]
        self.squares += step * step
        self.weights += RATE * step / np.sqrt(self.squares + 1e-6)
        near = cell + (part > 0.5)
        self.bits += [np.bincount(near, weight, self.bits.shape[1]), np.bincount(near, weight * bit, self.bits.shape[1])]


def stretched(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logit of counts, and whether they are many."""
    return np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4))), n0 + n1 > 30


def prefix_step(total: np.ndarray) -> np.ndarray:
    """The prefix's count, in steps of about four."""
    return np.minimum(np.log2(total + 1) / 2, GATE_STEPS - 1).astype(np.uint8)


def shares_of(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in lots of about the same number of tokens, mixed by hash: (word, tokens) of each share.

    A word with many tokens has shares in several lots, so that every token counts the same and no
    word rules a step. There are few more shares than words."""
    lots = -(-len(keys) // LOT_WORDS)
    times = np.ceil(counts * (8 * lots / max(1, counts.sum()))).astype(np.int64)
    word = np.repeat(np.arange(len(keys)), times)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(times) - times, times)
    order = np.argsort(mix(keys[word] + mix(nth.astype(np.uint64))), kind="stable")
    return word[order], (counts / np.maximum(1, times))[word[order]]


def train_mixer(mixer: Mixer, table: np.ndarray, keys: np.ndarray, counts: np.ndarray, data: np.ndarray, offsets: np.ndarray, turn: int) -> None:
    """One online pass over every ROUNDS-th lot of the words, each bit scored before it is learnt from and without its own occurrence."""
    word, weight = shares_of(keys, counts)
    for k in range(0, len(word), LOT_WORDS):
        if k // LOT_WORDS % ROUNDS != turn:
            continue
        spelling = Spelling(*_pick(data, offsets, word[k:k + LOT_WORDS]))
        tokens = weight[k:k + LOT_WORDS][spelling.order]
        for place, (at, byte, context) in enumerate(spelling.steps()):
            node = np.ones(len(at), np.uint64)
            for b in range(7, -1, -1):
                bit = ((byte >> U(b)) & U(1)).astype(np.int64)
                pairs = table.take(np.stack(slots(context, node)), axis=0)  # rows by plain indexing take 15 times as long
                pairs -= np.stack([1 - bit, bit], 1).astype(np.float32)
                own = np.maximum(0, pairs, out=pairs)
                stretch, sure = stretched(own[..., 0], own[..., 1])
                state = mixer.predict(stretch, sure, prefix_step(own[4, :, 0] + own[4, :, 1]), place, node)
                mixer.learn(bit, tokens[:len(at)], state)
                node = (node << U(1)) | bit.astype(np.uint64)
        mixer.refresh()


def code_lengths(table: tuple[np.ndarray, ...], mixer: Mixer, data: np.ndarray, offsets: np.ndarray, lot: int = 100_000) -> np.ndarray:
    """log10 probability of each word with its terminator, in single precision: p and 1 - p still add up to one.

    ``table``: what ``stretched`` and ``prefix_step`` say of each slot."""
    stretch, sure, seen = table
    out = np.zeros(len(offsets) - 1)
    for k in range(0, len(out), lot):
        cuts = offsets[k:k + lot + 1]
        spelling = Spelling(data, cuts)
        total = np.zeros(len(cuts) - 1)
        for place, (at, byte, context) in enumerate(spelling.steps()):
            node = np.ones(len(at), np.uint64)
            for b in range(7, -1, -1):
                bit = (byte >> U(b)) & U(1)
                where = np.stack(slots(context, node))
                p = mixer.predict(stretch[where], sure[where], seen[where[4]], place, node)[0]
                total[:len(at)] += np.log10(np.where(bit == 1, p, 1 - p))
                node = (node << U(1)) | bit
        out[k + spelling.order] = total
    return out


# --- the flow ---------------------------------------------------------------

_ROWS = ("chunk long, shard int, n long, keys binary, words binary, lengths binary, counts binary, "
         "doc_ids array<long>, held binary, bytes binary, tokens binary, first binary")


def _pack(x: np.ndarray) -> bytes:
    return x.nbytes.to_bytes(8, "little") + pa.Codec("zstd", PACK_LEVEL).compress(np.ascontiguousarray(x).tobytes(), asbytes=True) if x.nbytes else b""


def _unpack(b: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True), dtype) if b else np.zeros(0, dtype)


def _pack_ints(x: np.ndarray) -> bytes:
    """Whole numbers as their byte planes, low bytes first, as many planes as the largest needs."""
    x = np.ascontiguousarray(x, np.uint64)
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return len(x).to_bytes(8, "little") + bytes([width]) + _pack(x.view(np.uint8).reshape(-1, 8)[:, :width].T)


def _unpack_ints(b: bytes) -> np.ndarray:
    n, width = int.from_bytes(b[:8], "little"), b[8]
    out = np.zeros((n, 8), np.uint8)
    if width:
        out[:, :width] = _unpack(b[9:], np.uint8).reshape(width, n).T
    return out.view(np.int64).ravel()


def _width(b: bytes) -> int:
    """Bytes of an unsigned type that holds the numbers of ``_pack_ints``."""
    return next(k for k in (1, 2, 4, 8) if k >= b[8])


def _slot_blocks(b: bytes) -> Iterator[tuple[slice, np.ndarray]]:
    """The slots' counts from ``_pack_ints``, BLOCK slots at a time and in single precision."""
    n, width = int.from_bytes(b[:8], "little"), b[8]
    planes = _unpack(memoryview(b)[9:], np.uint8).reshape(width, n) if width else np.zeros((0, n), np.uint8)
    for lo in range(0, n, 2 * BLOCK):
        part = np.zeros(min(2 * BLOCK, n - lo), np.float32)
        for k, plane in enumerate(planes):
            part += plane[lo:lo + 2 * BLOCK] * np.float32(256**k)
        yield slice(lo // 2, lo // 2 + len(part) // 2), part.reshape(-1, 2)


def _slot_counts(b: bytes) -> np.ndarray:
    """The slots' counts (N_SLOTS, 2)."""
    out = np.empty((N_SLOTS, 2), np.float32)
    for at, part in _slot_blocks(b):
        out[at] = part
    return out


def _slot_table(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``stretched`` and ``prefix_step`` say of each slot; the counts themselves are not kept."""
    stretch, sure, seen = np.empty(N_SLOTS, np.float32), np.empty(N_SLOTS, bool), np.empty(N_SLOTS, np.uint8)
    for at, part in _slot_blocks(b):
        stretch[at], sure[at] = stretched(part[:, 0], part[:, 1])
        seen[at] = prefix_step(part.sum(1))
    return stretch, sure, seen


def _pack_floats(x: np.ndarray) -> bytes:
    return _pack_ints(np.ascontiguousarray(x, np.float32).view(np.uint32))


def _unpack_floats(b: bytes) -> np.ndarray:
    return _unpack_ints(b).astype(np.uint32).view(np.float32)


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return _pack_ints(np.diff(keys, prepend=U(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack_ints(b).view(np.uint64), dtype=np.uint64)


def ascending(keys: np.ndarray) -> np.ndarray:
    """Places of the keys (uint64) in ascending order, equal keys by place.

    Key and place are sorted as one number, several times as fast as sorting places by key. Low bits of the keys
    that find no room beside the place are put right by a stable sort of what is nearly in order."""
    if not len(keys):
        return np.zeros(0, np.int64)
    least, bits = keys.min(), len(keys).bit_length()
    packed = keys - least
    left_out = max(0, int(packed.max()).bit_length() + bits - 64)
    packed >>= U(left_out)
    packed <<= U(bits)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= U((1 << bits) - 1)
    order = packed.view(np.int64)
    return order[np.argsort(keys[order], kind="stable")] if left_out else order


def distinct_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, the first place of each, and each key's index among them."""
    order = ascending(keys)
    keys = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(first) - 1
    return keys[first], order[first], back


def _by_use(used: np.ndarray) -> np.ndarray:
    """Entries of a chunk, the most used first: tokens are kept as places in this order, small numbers for common words."""
    return np.argsort(-used, kind="stable")


def _ranks(used: np.ndarray) -> np.ndarray:
    out = np.empty(len(used), np.int64)
    out[_by_use(used)] = np.arange(len(used))
    return out


def _spelled(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given spans, one behind the other, and their offsets."""
    length = end - start
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return raw[np.repeat(start - (ends - length), length) + np.arange(total)], np.concatenate([[0], ends])


def chunks(docs: DataFrame, held_out) -> DataFrame:
    """Rows of two sorts: a chunk's texts as word indices (shard -1; n counts tokens), and the chunk's
    distinct words by shard with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            raw, offsets = utf8_buffer(batch.column("text"))
            raw = LOWER[raw]
            start, end, first = word_spans(raw, offsets)
            keys = np.maximum(span_hashes(raw, start, end), U(1))
            ids, held = batch.column("doc_id").to_pylist(), np.array(batch.column("held").to_pylist(), bool)
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(first, first[lo] + CHUNK_TOKENS, "right")) - 1)
                a, b = first[lo], first[hi]
                distinct, sample, back = distinct_of(keys[a:b])
                train = ~np.repeat(held[lo:hi], np.diff(first[lo:hi + 1]))
                counts = np.bincount(back[train], minlength=len(distinct))
                # the end symbol is an empty word with key 0
                distinct, counts = np.concatenate([[END_KEY], distinct]), np.concatenate([[(~held[lo:hi]).sum()], counts])
                used = np.concatenate([[hi - lo], np.bincount(back, minlength=len(distinct) - 1)])
                s, e = np.concatenate([[0], start[a:b][sample]]), np.concatenate([[0], end[a:b][sample]])
                cuts = np.searchsorted(distinct, np.arange(1 << SHARD_BITS, dtype=np.uint64) << U(64 - SHARD_BITS))
                rows = [{"chunk": chunk, "shard": -1, "n": int(b - a) + hi - lo, "keys": _pack_sorted(distinct >> U(64 - WORD_KEY_BITS)),
                         "doc_ids": ids[lo:hi], "held": held[lo:hi].tobytes(), "bytes": _pack_ints(np.diff(offsets[lo:hi + 1])),
                         "counts": _pack_ints(used), "tokens": _pack_ints(_ranks(used)[back + 1]), "first": (first[lo:hi + 1] - a).tobytes()}]
                for shard, (x, y) in enumerate(zip(cuts, [*cuts[1:], len(distinct)])):
                    if x < y:
                        data, o = _spelled(raw, s[x:y], e[x:y])
                        rows.append({"chunk": chunk, "shard": shard, "n": int(y - x), "words": _pack(data), "lengths": _pack_ints(np.diff(o)),
                                     "counts": _pack_ints(counts[x:y])})
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                chunk, lo = chunk + 1, hi

    return docs.select("doc_id", "text", held_out.alias("held")).mapInArrow(run, _ROWS)


_B = pa.binary()
_ARROW = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("n", pa.int64()), ("keys", _B), ("words", _B), ("lengths", _B), ("counts", _B),
                    ("doc_ids", pa.list_(pa.int64())), ("held", _B), ("bytes", _B), ("tokens", _B), ("first", _B)])


def _joined(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Entries of several rows of one shard: keys (hashed anew from the words), counts, word bytes, word offsets."""
    counts = np.concatenate([_unpack_ints(x) for x in pdf["counts"]])
    length = np.concatenate([_unpack_ints(x) for x in pdf["lengths"]])
    data = np.concatenate([_unpack(x, np.uint8) for x in pdf["words"]])
    offsets = np.concatenate([[0], np.cumsum(length)])
    keys = np.full(len(length), END_KEY)
    some = length > 0
    if some.any():
        keys[some] = np.maximum(span_hashes(data, offsets[:-1][some], offsets[1:][some]), U(1))
    return keys, counts, data, offsets


def _pick(data: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _spelled(data, offsets[:-1][which], offsets[1:][which])


def split_shards(entries: DataFrame, total: int) -> DataFrame:
    """Cut every shard into sub-shards, by the next bits of the key, so that one has about
    SHARD_ENTRIES entries; adds ``sub``. Entries stay in key order."""
    parts = 1
    while total / (1 << SHARD_BITS) / parts > SHARD_ENTRIES:
        parts *= 2
    if parts == 1:
        return entries.withColumn("sub", F.lit(0))
    bits = parts.bit_length() - 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for i in range(len(pdf)):
                row = pdf.iloc[i:i + 1]
                keys, counts, data, offsets = _joined(row)
                sub = (keys << U(SHARD_BITS)) >> U(64 - bits)
                for s in np.unique(sub):
                    w = np.flatnonzero(sub == s)
                    d, o = _pick(data, offsets, w)
                    yield row.assign(n=len(w), words=_pack(d), lengths=_pack_ints(np.diff(o)), counts=_pack_ints(counts[w]), sub=int(s))

    return entries.mapInPandas(run, _ENTRY + ", sub int")


_ENTRY = "chunk long, shard int, n long, words binary, lengths binary, counts binary"


def vocabulary(entries: DataFrame) -> DataFrame:
    """Per sub-shard: its distinct words, spelled once, with their training counts; and where each chunk's
    entries stand among them."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, counts, data, offsets = _joined(pdf)
        distinct, at, back = np.unique(keys, return_index=True, return_inverse=True)
        total = np.bincount(back, counts, len(distinct)).astype(np.int64)
        d, o = _pick(data, offsets, at)
        places = [_pack_sorted(x.astype(np.uint64)) for x in np.split(back, np.cumsum(pdf["n"].to_numpy())[:-1])]
        return pd.DataFrame({"shard": [int(key[0])], "sub": [int(key[1])], "tokens": [int(total.sum())], "distinct": [int((total > 0).sum())],
                             "counts": [_pack_ints(total)], "words": [_pack(d)], "lengths": [_pack_ints(np.diff(o))],
                             "chunks": [pdf["chunk"].tolist()], "places": [places]})

    return entries.groupBy("shard", "sub").applyInPandas(
        run, "shard int, sub int, tokens long, distinct long, counts binary, words binary, lengths binary, "
             "chunks array<long>, places array<binary>")


def count_table(vocab: DataFrame) -> np.ndarray:
    """The slots' counts over all training words: partial tables per task, summed by block."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in frames:
            for i in range(len(pdf)):
                _, counts, data, offsets = _joined(pdf.iloc[i:i + 1])
                known = np.flatnonzero(counts)
                total = np.zeros(2 * N_SLOTS) if total is None else total
                add_bits(total, *_pick(data, offsets, known), counts[known])
        if total is not None:
            for b in range(0, N_SLOTS, BLOCK):
                yield pd.DataFrame({"block": [b], "counts": [_pack_ints(total[2 * b:2 * (b + BLOCK)])]})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unpack_ints(x) for x in pdf["counts"])
        return pd.DataFrame({"block": [key[0]], "counts": [_pack_ints(total)]})

    parts = vocab.select("counts", "words", "lengths").mapInPandas(partial, "block long, counts binary")
    rows = parts.groupBy("block").applyInPandas(add, "block long, counts binary").collect()  # N_SLOTS * 8 bytes at most
    table = np.zeros((N_SLOTS, 2), np.float32)
    for r in rows:
        got = _unpack_ints(bytes(r["counts"])).reshape(-1, 2)
        table[r["block"]:r["block"] + len(got)] = got
    return table


def fit_mixer(vocab: DataFrame, counts, n_distinct: int) -> Mixer:
    """A mixer learnt online from all training words. Groups of shards learn side by side, from the mixer of the round
    before; their weights are averaged by tokens, the cells of their refining tables add up."""
    groups = max(1, n_distinct // GROUP_WORDS)
    words = vocab.select(F.pmod(F.col("shard") + F.col("sub") * (1 << SHARD_BITS), F.lit(groups)).alias("group"), "counts", "words", "lengths")
    mixer = Mixer()
    for turn in range(ROUNDS):
        start = mixer.weights, mixer.bits

        def learn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            keys, count, data, offsets = _joined(pdf)
            known = np.flatnonzero(count)
            own = Mixer()
            own.weights, own.bits = (x.copy() for x in start)
            own.refresh()
            train_mixer(own, _slot_counts(counts.value), keys[known], count[known], *_pick(data, offsets, known), turn)
            return pd.DataFrame({"group": [key[0]], "tokens": [float(count.sum())], "weights": [own.weights.tobytes()], "bits": [_pack(own.bits - start[1])]})

        learnt = sorted(words.groupBy("group").applyInPandas(learn, "group long, tokens double, weights binary, bits binary").collect(), key=lambda r: r["group"])
        tokens = sum(r["tokens"] for r in learnt)
        if tokens:
            mixer.weights = sum(np.frombuffer(r["weights"]).reshape(mixer.weights.shape) * (r["tokens"] / tokens) for r in learnt)
            mixer.bits = start[1] + sum(_unpack(bytes(r["bits"]), float).reshape(mixer.bits.shape) for r in learnt)
            mixer.refresh()
    return mixer


# --- contexts that span words -------------------------------------------------

def sequence(tokens: bytes, used: bytes, first: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's word indices with an end symbol (entry 0) behind each text, and where each text begins."""
    first = np.frombuffer(first, np.int64)
    at = _by_use(_unpack_ints(used))[_unpack_ints(tokens)]
    return np.insert(at, first[1:], 0), first[:-1] + np.arange(len(first) - 1)


def before(x: np.ndarray, starts: np.ndarray, at_start) -> np.ndarray:
    """The value one place earlier in the text."""
    out = np.concatenate([x[:1], x[:-1]])
    out[starts] = at_start
    return out


def span_keys(at: np.ndarray, starts: np.ndarray, keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct keys, of ``bits`` bits, of word pairs and triples, and each token's index of its pair and its triple."""
    n = len(at)
    both = np.empty(2 * n, np.uint64)  # pairs, then triples
    word = keys[at]
    one = before(word, starts, START_KEY)
    two = before(one, starts, START_KEY)
    for k in range(0, n, SLICE_TOKENS):
        x, y = slice(k, min(k + SLICE_TOKENS, n)), slice(n + k, n + min(k + SLICE_TOKENS, n))
        both[x] = mix(word[x] * U(0x9E3779B97F4A7C15) + mix(one[x] + U(0xB5297A4D)))
        both[y] = mix(both[x] * U(0xC2B2AE3D27D4EB4F) + mix(two[x] + U(0x68E31DA4)))
    del word, one, two
    both >>= U(64 - bits)
    # np.unique with the inverse, in less memory
    order = ascending(both)
    both = both[order]
    first = np.ones(2 * n, bool)
    first[1:] = both[1:] != both[:-1]
    both = both[first]
    back = np.empty(2 * n, np.int32)
    back[order] = np.cumsum(first, dtype=np.int32) - np.int32(1)
    return both, back[:n], back[n:]


def span_bits(tokens: int) -> int:
    """Bits of a span key for this many tokens, two keys each: they grow with the data."""
    return min(64, SPARE_BITS + max(8, (2 * tokens).bit_length()))


def span_counts(texts: DataFrame, tokens: int) -> DataFrame:
    """Per chunk and shard: the training counts of the chunk's distinct pair and triple keys, in key order."""
    bits, width = max(SHARD_BITS, (2 * tokens // SHARD_ENTRIES).bit_length()), span_bits(tokens)

    def of_chunk(r: pd.Series) -> pd.DataFrame:
        at, starts = sequence(r["tokens"], r["counts"], r["first"])
        distinct, pair, triple = span_keys(at, starts, _unpack_sorted(r["keys"]), width)
        train = ~np.repeat(np.frombuffer(r["held"], bool), np.diff(np.append(starts, len(at))))
        counts = np.bincount(np.concatenate([pair[train], triple[train]]), minlength=len(distinct))
        cuts = np.append(np.searchsorted(distinct, np.arange(1 << bits, dtype=np.uint64) << U(width - bits)), len(distinct))
        out = [(r["chunk"], k, y - x, _pack_sorted(distinct[x:y]), _pack_ints(counts[x:y]))
               for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if x < y]
        return pd.DataFrame(out, columns=["chunk", "shard", "n", "keys", "counts"])

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, r in pdf.iterrows():
                yield of_chunk(r)  # a chunk's arrays are gone before the next one's are made

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        distinct, _, back = distinct_of(np.concatenate([_unpack_sorted(x) for x in pdf["keys"]]))
        count = np.bincount(back, np.concatenate([_unpack_ints(x) for x in pdf["counts"]]), len(distinct)).astype(np.int64)
        cuts = np.cumsum(pdf["n"].to_numpy())[:-1]
        return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "sub": -1, "counts": [_pack_ints(count[x]) for x in np.split(back, cuts)], "logs": b""})

    rows = texts.select("chunk", "held", "keys", "counts", "tokens", "first").mapInPandas(entries, "chunk long, shard int, n long, keys binary, counts binary")
    return rows.groupBy("shard").applyInPandas(add, "chunk long, shard int, sub int, counts binary, logs binary")


class Spans:
    """A chunk's tokens with the counts of their contexts; ``own`` is taken off both counts of a training token.
    Probabilities are made for a slice of tokens at a time."""

    def __init__(self, r: pd.Series, leave_out: bool):
        self.at, self.starts = sequence(r["tokens"], r["used"], r["first"])
        self.at = self.at.astype(np.int32)  # entries of one chunk
        self.plain = 10.0 ** np.maximum(_unpack_floats(r["logs"]).astype(float), -290)
        # counts are kept in as few bytes as the largest needs
        kind = f"u{max(_width(r[c]) for c in ('counts', 'pairs', 'triples'))}"
        self.words, pair, triple = (_unpack_ints(r[c]).astype(kind) for c in ("counts", "pairs", "triples"))
        texts = self.words[0]  # every text has one end symbol
        self.train = ~np.repeat(np.frombuffer(r["held"], bool), np.diff(np.append(self.starts, len(self.at))))
        self.leave_out = leave_out
        self.counts = ((pair, before(self.words[self.at], self.starts, texts)), (triple, before(pair, self.starts, texts)))

    def slices(self) -> Iterator[slice]:
        return (slice(k, k + SLICE_TOKENS) for k in range(0, len(self.at), SLICE_TOKENS))

    def order(self, k: int, x: slice) -> tuple[np.ndarray, np.ndarray]:
        """Share of the token among what followed its context, and the context's gate."""
        own = self.train[x].astype(np.int64) if self.leave_out else 0
        count, context = (c[x].astype(np.int64) - own for c in self.counts[k])
        some = np.maximum(context, 1)
        return np.where(context > 0, count / some, 0.0), np.where(context > 0, 1 + np.log2(some).astype(np.int64), 0)

    def mixed(self, shares: list[np.ndarray], x: slice) -> np.ndarray:
        """Probability of each token by the shortest contexts, as many as ``shares`` has gates for."""
        p = self.plain[self.at[x]]
        for k, share in enumerate(shares):
            seen, gate = self.order(k, x)
            p = share[gate] * seen + (1 - share[gate]) * p
        return p


def fit_shares(joined: DataFrame) -> list[np.ndarray]:
    """The share of each context by gate that codes all training tokens best, each without its own occurrence.

    A token's code length differs between shares by log(1 + share * (seen / mixed - 1)) alone, so tasks count
    the tokens by gate and step of that ratio, and the shares are chosen from the counts."""
    shares: list[np.ndarray] = []
    steps = 2 * RATIO_STEPS * RATIO_OCTAVES
    ratio = np.append(0.0, 2.0 ** ((np.arange(steps) + 0.5) / RATIO_STEPS - RATIO_OCTAVES))  # step 0: the token was not seen there
    gain = np.log1p(SHARES[:, None] * (ratio - 1))
    for order in range(2):
        known = list(shares)

        def add(total: np.ndarray, r: pd.Series) -> None:
            s = Spans(r, True)
            for x in s.slices():
                train = s.train[x]
                seen, gate = (v[train] for v in s.order(order, x))
                p, some = s.mixed(known, x)[train], seen > 0
                step = np.zeros(len(seen), np.int64)
                step[some] = 1 + np.clip((np.log2(seen[some] / p[some]) + RATIO_OCTAVES) * RATIO_STEPS, 0, steps - 1).astype(np.int64)
                total += np.bincount(gate * (steps + 1) + step, minlength=len(total))

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(SPAN_GATES * (steps + 1), np.int64)
            for pdf in frames:
                for _, r in pdf.iterrows():
                    add(total, r)
            at = np.flatnonzero(total)
            yield pd.DataFrame({"at": at, "n": total[at]})

        rows = joined.mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # SPAN_GATES * (steps + 1) at most
        total = np.zeros(SPAN_GATES * (steps + 1))
        for r in rows:
            total[r["at"]] = r["n"]
        best = SHARES[(total.reshape(SPAN_GATES, -1) @ gain.T).argmax(1)]
        best[0] = 0.0  # a context never seen
        shares.append(best)
    return shares


def score(docs: DataFrame, held_out=None) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    held_out = fold(F.col("doc_id"), 7) if held_out is None else held_out
    rows = staged_by(chunks(docs, held_out), "chunks", "chunk")  # answers come to a chunk, its texts stay where they are
    entries = rows.filter("shard >= 0").select(*[c.split()[0] for c in _ENTRY.split(", ")])
    size = entries.agg(F.sum("n").alias("n")).first()["n"] or 0
    entries = split_shards(entries, size)
    texts = rows.filter("shard < 0").select("chunk", "doc_ids", "held", "bytes", "keys", "counts", "tokens", "first")
    n_tokens = rows.filter("shard < 0").agg(F.sum("n").alias("n")).first()["n"] or 0
    vocab = staged(vocabulary(entries), "vocabulary")
    totals = vocab.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    n_train, n_distinct = int(totals["n"]), int(totals["v"])
    counts = spark.sparkContext.broadcast(_pack_ints(count_table(vocab).ravel()))  # N_SLOTS * 8 bytes at most, packed
    fitted = fit_mixer(vocab, counts, n_distinct)
    learnt = fitted.weights.astype(np.float32), fitted.bits

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mixer = Mixer(np.float32)
        mixer.weights, mixer.bits = learnt
        mixer.refresh()
        table = _slot_table(counts.value)
        for pdf in frames:
            for i in range(len(pdf)):
                r = pdf.iloc[i]
                _, count, data, offsets = _joined(pdf.iloc[i:i + 1])
                bits = code_lengths(table, mixer, data, offsets).astype(np.float32)
                for chunk, places in zip(r["chunks"], r["places"]):
                    x = _unpack_sorted(places).astype(np.int64)
                    yield pd.DataFrame({"chunk": [chunk], "shard": [r["shard"]], "sub": [r["sub"]], "counts": [_pack_ints(count[x])], "logs": [_pack_floats(bits[x])]})

    answers = vocab.select("shard", "sub", "counts", "words", "lengths", "chunks", "places").mapInPandas(
        answer, "chunk long, shard int, sub int, counts binary, logs binary")

    width = span_bits(n_tokens)

    def joined(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values(["shard", "sub"])
        words, spans = right[right["sub"] >= 0], right[right["sub"] < 0]
        r = left.iloc[0]  # a chunk is one row
        _, pair, triple = span_keys(*sequence(r["tokens"], r["counts"], r["first"]), _unpack_sorted(r["keys"]), width)
        count = np.concatenate([_unpack_ints(x) for x in spans["counts"]])
        return left.drop(columns="keys").rename(columns={"counts": "used"}).assign(
            counts=_pack_ints(np.concatenate([_unpack_ints(x) for x in words["counts"]])),
            logs=_pack_floats(np.concatenate([_unpack_floats(x) for x in words["logs"]])),
            pairs=_pack_ints(count[pair]), triples=_pack_ints(count[triple]))

    counted = staged(texts.groupBy("chunk").cogroup(answers.unionByName(span_counts(texts, n_tokens)).groupBy("chunk")).applyInPandas(
        joined, "chunk long, doc_ids array<long>, held binary, bytes binary, used binary, tokens binary, first binary, "
                "counts binary, logs binary, pairs binary, triples binary"), "counted")
    shares = fit_shares(counted)

    def of_chunk(r: pd.Series) -> pd.DataFrame:
        spans = Spans(r, False)
        base, known = np.log10((spans.words.astype(np.int64) + 1.0) / (n_train + n_distinct + 1.0)), (spans.words > 0).astype(np.int64)
        s = np.add.reduceat(np.concatenate([np.log10(spans.mixed(shares, x)) for x in spans.slices()]), spans.starts)
        b = np.add.reduceat(base[spans.at], spans.starts)
        k = np.add.reduceat(known[spans.at], spans.starts)
        n_bytes = _unpack_ints(r["bytes"])
        return pd.DataFrame({
            "doc_id": pd.array([None if x is None or x != x else int(x) for x in r["doc_ids"]], "Int64"), "held_out": np.frombuffer(r["held"], bool),
            "n_tokens": np.diff(np.append(spans.starts, len(spans.at))), "n_known": k, "train_tokens": n_train, "base_score": b, "score": s,
            "bits_per_byte": -s * np.log2(10) / np.maximum(1, n_bytes)})

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, r in pdf.iterrows():
                yield of_chunk(r)

    return counted.mapInPandas(
        total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")

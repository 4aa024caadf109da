"""Packing token sequences into windows by minimum bin slack.

A document's ids are cut into full windows and one remainder. Full windows
need no packing. Remainders are dealt into groups of bounded size; a group
keeps only how many pieces of each length are left. Each window is opened with
the longest piece left, and a subset-sum dynamic programme over the multiset
of remaining lengths (bits of one integer are the reachable sums) finds the
fill closest to the window; the counts used are read back from the bitsets.

Edge cases. Null and empty texts hold the end id alone. Null or repeated ids
and repeated rows: each row is a document of its own. Texts of any length are
cut into as many windows as they need. Empty table: empty result.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tally.llm.stage import staged
from tally.llm.textual import span_hashes, utf8_buffer, word_spans

#: Parameters: window in tokens, id that ends a document, pieces a group packs together.
WINDOW = 4096
END_ID = 2
GROUP_PIECES = 8_000
TOKENIZER_FILE = "word_bpe_49k.json"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: Fixed value: the vocabulary's own split of a text into pieces.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LOT_WORDS = 2_000
#: Bytes of text worked on at once, and words that a worker remembers.
SLICE_BYTES = 1 << 22
KNOWN_WORDS = 1_500_000


def word_encoder(tokenizer_file: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of words that hold no ASCII white space. The vocabulary drops white space and never
    merges across it, so a text's ids are its words' ids in a row.

    Words are normalised and split into the vocabulary's pieces here, and all pieces of
    many words go to the tokenizer in one call, joined by blanks. A piece's last id ends in
    ``</w>``, so ids are dealt back by counting pieces per word; a lot whose counts
    differ is encoded word by word, by the vocabulary's own steps.
    """
    import unicodedata

    import public_tokenizers
    import regex
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokenizer_file))
    shaped = Tokenizer.from_file(public_tokenizers.path(tokenizer_file))
    shaped.normalizer = normalizers.Sequence([])
    shaped.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])
    pieces_of = regex.compile(PIECE).findall
    ends = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    ends[[i for w, i in tokenizer.get_vocab().items() if w.endswith("</w>")]] = True

    def lot(words: list[str]) -> list[list[int]]:
        forms = unicodedata.normalize("NFC", " ".join(words)).lower().split(" ")
        parts = [(w,) if w.isalpha() else pieces_of(w) for w in forms]
        counts = np.array([len(x) for x in parts])
        joined = " ".join([y for x in parts for y in x])
        if len(forms) == len(words) and counts.min() > 0 and "<|" not in joined:
            ids = shaped.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            last = np.flatnonzero(ends[ids])
            if counts.sum() == len(last) and last[-1] == len(ids) - 1:
                cuts = np.concatenate([[0], last[np.cumsum(counts) - 1] + 1]).tolist()
                return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    return lambda words: [x for k in range(0, len(words), LOT_WORDS) for x in lot(words[k:k + LOT_WORDS])]


class TokenStream:
    """Texts to ids; each distinct word is encoded once while the table of known words is
    below ``max_words`` (then it starts anew). Words are known by 64-bit hash."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], max_words: int = KNOWN_WORDS):
        self.encode, self.max_words = encode, max_words
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def __call__(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets per text), without end ids."""
        raw, offsets = utf8_buffer(col)
        start, end, first = word_spans(raw, offsets)
        distinct, sample, back = np.unique(span_hashes(raw, start, end), return_index=True, return_inverse=True)
        if len(self.keys) > self.max_words:
            self.reset()
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            whole = raw.tobytes()
            got = self.encode([whole[a:b].decode("utf-8", "replace") for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())])
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            fresh = np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum()))
            self.begin = np.insert(self.begin, place[new], len(self.ids) + np.cumsum(lengths) - lengths)
            self.count = np.insert(self.count, place[new], lengths)
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.ids = np.concatenate([self.ids, fresh])
            place = np.searchsorted(self.keys, distinct)
        n_ids = self.count[place][back].astype(np.int64)
        ends = np.cumsum(n_ids)
        total = int(ends[-1]) if len(ends) else 0
        # id k of the output is id (k - first of its word) of its word's entry
        source = np.repeat(self.begin[place][back] - (ends - n_ids), n_ids) + np.arange(total)
        return self.ids[source], np.concatenate([[0], ends])[first]


def worker_stream(tokenizer_file: str) -> TokenStream:
    """The token stream of this Python worker: Spark hands it many tasks, which share the words known."""
    home = sys.modules.setdefault("_tally_token_streams", types.ModuleType("_tally_token_streams"))
    if tokenizer_file not in home.__dict__:
        home.__dict__[tokenizer_file] = TokenStream(word_encoder(tokenizer_file))
    return home.__dict__[tokenizer_file]


def pieces(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Cut every document's ids (with the end id) into windows and a remainder (PIECES columns)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = worker_stream(tokenizer_file)
        for batch in batches:
            for lo, n in slices(batch.column("text")):
                ids, offsets = stream(batch.column("text").slice(lo, n))
                whole = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
                size = np.diff(offsets) + 1
                per = -(-size // window)
                doc = np.repeat(np.arange(n), per)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * window
                length = np.minimum(window, size[doc] - start)
                at = (offsets[:-1] + np.arange(n))[doc] + start
                data = memoryview(whole.tobytes())
                crc = [zlib.crc32(data[a:b]) for a, b in zip((4 * at).tolist(), (4 * (at + length)).tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n).cast(pa.int64()).take(pa.array(doc)),
                                                  *[pa.array(c, pa.int64()) for c in (start, length, crc, size[doc])]],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of whole texts of about ``most`` bytes."""
    _, offsets = utf8_buffer(col)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi - lo
        lo = hi


def fill(counts: dict[int, int], room: int) -> list[int]:
    """Lengths from the multiset ``counts`` whose sum is as near to ``room`` as any, at most it.

    Lengths go in from long to short; bit b of ``sums`` says that b can be
    reached. A length with several pieces is added in doubling lots, so that
    a step costs one shift. Walking the steps back yields the lots used.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, lot = min(counts[length], room // length), 1
        while left > 0:
            lot = min(lot, left)
            steps.append((length, lot, sums))
            sums |= (sums << (length * lot)) & mask
            left -= lot
            lot *= 2
        if sums >> room & 1:
            break
    rest, used = sums.bit_length() - 1, []
    for length, lot, before in reversed(steps):
        if not before >> rest & 1:
            used += [length] * lot
            rest -= length * lot
    return used


def pack_lengths(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of lengths; every length is used once."""
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    out = []

    def take(x: int) -> None:
        counts[x] -= 1
        if not counts[x]:
            del counts[x]

    longest = sorted(counts, reverse=True)
    for x in longest:
        while counts.get(x):
            take(x)
            more = fill(counts, window - x)
            for y in more:
                take(y)
            out.append([x, *more])
    return out


def pack(cut: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place every piece: adds sequence_id and offset. ``cut`` is read three times: stage it.

    Remainders go to groups by a hash of the piece, about ``group_pieces`` to a
    group whatever the size of the corpus, so a task's memory is bounded and
    more data means more groups. A group's windows are numbered within the
    group's own range of sequence ids.
    """
    part = cut.filter(F.col("length") < window)
    groups = part.agg(F.ceil(F.count(F.lit(1)) / group_pieces).alias("n")).select(F.greatest(F.lit(1), "n").alias("n"))
    part = part.join(F.broadcast(groups)).withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.lit(1)), F.col("n"))).drop("n")

    def place(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        nxt = {int(x): int(i) for x, i in zip(*np.unique(lengths, return_index=True))}
        rows, seq, off = [], [], []
        for k, used in enumerate(pack_lengths(lengths.tolist(), window)):
            at = 0
            for x in used:
                rows.append(nxt[x])
                nxt[x] += 1
                seq.append(k)
                off.append(at)
                at += x
        out = pdf.iloc[rows].drop(columns="_group").reset_index(drop=True)
        return out.assign(sequence_id=(int(key[0]) << 32) + np.array(seq, np.int64), offset=np.array(off, np.int64))

    schema = PIECES + ", sequence_id long, offset long"
    packed = part.groupBy("_group").applyInPandas(place, schema)
    # full windows: ids from the far end of the range, one per document row and window
    whole = cut.filter(F.col("length") >= window).select(
        "*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    return pack(staged(pieces(docs, tokenizer_file), "pieces"))

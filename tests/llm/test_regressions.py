"""Inputs that once hung, crashed or gave wrong rows."""

import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from tally.llm import context_mixing, html_text, mixing, near_dedup, neighbours, packing
from tally.llm.stage import maybe_in


def test_unclosed_marks_end_in_useful_time():
    for page in ("<a" * 100_000, "<a " * 60_000 + '"' + ">", "<a '" * 50_000, "<b>" * 3000 + "</i>" * 50_000, "<!--" * 50_000, "<a <b " * 40_000 + ">x</a>"):
        t = time.process_time()
        html_text.parse(page)
        assert time.process_time() - t < 4
    root = html_text.parse('<p title="a > b">one</p></i><p>two <b c=">three')
    assert [x.tag for x in html_text.elements(root)] == ["#root", "p", "p", "b"]


def test_tiny_huge_and_scaled_vectors(spark):
    rows = [(i, [float(i + 1) * x for x in (0.3, -0.2, 0.9)]) for i in range(40)]
    rows += [(100, [1e-200, 2e-200, 3e-200]), (101, [1e200, 2e200, 3e200]), (102, [1.0, 2.0, 3.0]), (103, [5e-324, 0.0, 0.0]), (104, [0.0, 0.0, 0.0]), (105, None)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(d, F.col("vec_id").isin(0, 100, 103)).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    best = [v for v, s in got[0]]
    exact = [(v, s) for v, s in got[0] if abs(s - 1) < 1e-12]
    assert len(exact) == 5 and got[0] == sorted(got[0], key=lambda x: (-x[1], x[0])) and max(best) < 40
    assert {v for v, s in got[100][:2]} == {101, 102} and all(abs(s - 1) < 1e-12 for _, s in got[100][:2])
    assert len(got[103]) == 5 and all(s == s for _, s in got[103])


def test_one_row_of_a_group_stays_whatever_its_id(spark):
    text = "one two three four five six seven eight nine ten"
    other = "an altogether different text of more than five words in all"
    rows = [(1, text, "a"), (1, text, "b"), (2, text, "c"), (None, text, "d"), (None, text, "e"), (2, other, "f"), (9, "", "g"), (9, None, "h")]
    d = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = near_dedup.deduplicate(d)
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == d.columns and sorted(str(r[1]) for r in got) == sorted([text, other, "", "None"])
    assert [r[0] for r in got if r[1] == text] == [1] and near_dedup.deduplicate(d.limit(0)).count() == 0


def test_rows_that_surely_stay_are_not_shuffled(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("k"), "id")
    near, far = maybe_in(rows, "k", spark.range(0, 3000, 3).select(F.col("id").alias("k")))
    near, far = ([r.k for r in x.collect()] for x in (near, far))
    assert len(near) + len(far) == 20_000 and set(range(0, 3000, 3)) - set(range(7, 3000, 100)) <= set(near) and len(near) < 3000 and far.count(None) == 200
    near, far = maybe_in(rows, "k", rows.select("k").limit(0))
    assert near.count() == 0 and far.count() == 20_000
    words = [f"w{i}" for i in range(90)]
    docs = spark.createDataFrame([(i, " ".join(words[i:i + 8])) for i in range(0, 80, 8)] + [(100, "w0 w1 w2 w3 w4 w5 w6 w7")], "doc_id long, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        kept = near_dedup.deduplicate(docs)
        plan = kept._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    first = plan.children().head().toString()  # of a union: the rows that need no exact join
    assert plan.nodeName() == "Union" and "LeftSemi" not in first and "LeftAnti" not in first
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 8))


def test_slices_hold_whole_texts():
    import pyarrow as pa
    col = pa.array(["a" * 10, None, "", "b" * 50, "c" * 5, "d"])
    cut = list(packing.slices(col, 12))
    assert [n for _, n in cut] == [3, 1, 2] and cut[0][0] == 0 and sum(n for _, n in cut) == 6
    assert list(packing.slices(pa.array([], pa.string()))) == []


def test_the_mixer_learns_from_every_training_word(spark):
    """Each word's tokens come up in the shares whole, however often it occurs; both rounds together hold all shares."""
    rng = np.random.default_rng(3)
    counts = np.concatenate([rng.integers(1, 9, 30_000), [10**6, 10**5]])
    word, weight = context_mixing.shares_of(rng.integers(1, 2**63, len(counts)).astype(np.uint64), counts)
    assert np.allclose(np.bincount(word, weight, len(counts)), counts) and len(word) < len(counts) + 100
    data, offsets = np.frombuffer(b"abcabd", np.uint8), np.array([0, 3, 6])
    table = context_mixing.count_bits(data, offsets, np.array([5, 2]))
    mixer = context_mixing.Mixer()
    for turn in range(context_mixing.ROUNDS):
        context_mixing.train_mixer(mixer, table, np.array([7, 8], np.uint64), np.array([5, 2]), data, offsets, turn)
    assert mixer.bits[0].sum() == 7 * 4 * 8  # seven tokens of three letters and a terminator


def test_mix_rows_come_from_the_sorted_run(spark):
    """The takes of all documents, laid end to end by training position, fill the run without gaps and follow the schedules."""
    texts = [(i, " ".join(["w"] * (1 + i % 7)) if i % 11 else None, "abc"[i % 3]) for i in range(400)] + [(None, "x y", "a"), (5, "w", "a"), (5, "w", "a")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts) and [r.first_position for r in rows] == sorted(r.first_position for r in rows)
    run = sorted(mixing.copies(mixing.plan(docs)).collect(), key=lambda r: (r._position, r.doc_id is not None, r.doc_id or 0, r._copy, r._row))
    at, first, taken = 0, {}, {}
    for r in run:
        first.setdefault(r._row, at)
        at, taken[r._row] = at + r._words, taken.get(r._row, 0) + r._words
    assert max(r.last_word for r in rows) == at == sum(r.taken for r in rows)
    assert sorted((r.first_word, r.taken) for r in rows if r.taken) == sorted((first[k], n) for k, n in taken.items() if n)
    early = sum(r.taken for r in rows if r.source == "a" and r.first_position < 0.25)  # slope 0.5: more of it early on
    assert early > 0.25 * sum(r.taken for r in rows if r.source == "a")


def test_a_chunks_span_keys_and_the_slots_table_take_little_memory():
    import tracemalloc
    n = 600_000
    rng = np.random.default_rng(5)
    at, starts, keys = rng.integers(0, 50_000, n), np.array([0, n // 3]), rng.integers(1, 2**48, 50_000).astype(np.uint64)
    tracemalloc.start()
    distinct, pair, triple = context_mixing.span_keys(at, starts, keys, 33)
    assert tracemalloc.get_traced_memory()[1] < 110 * n
    tracemalloc.stop()
    assert (np.diff(distinct.astype(np.int64)) > 0).all() and distinct.max() < 2**33 and len(pair) == len(triple) == n
    found, back = np.unique(np.concatenate([pair, triple]), return_inverse=True)
    assert (found == np.arange(len(distinct))).all()
    counts = rng.integers(0, 300, (context_mixing.N_SLOTS, 2)).astype(np.float32)
    packed = context_mixing._pack_ints(counts.ravel())
    assert (context_mixing._slot_counts(packed) == counts).all()
    tracemalloc.start()
    stretch, sure, seen = context_mixing._slot_table(packed)
    assert tracemalloc.get_traced_memory()[1] < 14 * context_mixing.N_SLOTS
    tracemalloc.stop()
    want = context_mixing.stretched(counts[:, 0], counts[:, 1])
    assert np.allclose(stretch, want[0]) and (sure == want[1]).all() and (seen == context_mixing.prefix_step(counts.sum(1))).all()


def test_keys_are_sorted_with_their_places():
    """Order, distinct keys and indices as by numpy's own, for keys that fit beside their place and for those that do not, in less time."""
    rng = np.random.default_rng(11)
    for bits in (1, 20, 39, 64):
        for n in (0, 1, 2, 5000):
            keys = rng.integers(0, 2**bits, n, dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 2**64 - 1, n, dtype=np.uint64, endpoint=True)
            keys = np.concatenate([keys, keys[::3], keys[:n // 2] ^ np.uint64(1)])
            assert (context_mixing.ascending(keys) == np.argsort(keys, kind="stable")).all()
            for got, want in zip(context_mixing.distinct_of(keys), np.unique(keys, return_index=True, return_inverse=True)):
                assert (got == want).all() and len(got) == len(want)
    keys = rng.integers(0, 2**39, 2_000_000, dtype=np.uint64)

    def seconds(f):
        t = time.process_time()
        f(keys)
        return time.process_time() - t

    assert min(seconds(context_mixing.ascending) for _ in range(3)) < 0.75 * min(seconds(np.argsort) for _ in range(3))


def test_mixer_takes_rows_of_the_table():
    """Rows of counts by plain indexing took more than half of the mixer's time."""

    class Counts(np.ndarray):
        def __getitem__(self, at):
            assert not (isinstance(at, np.ndarray) and at.ndim == 2), "rows by plain indexing"
            return super().__getitem__(at)

    data, offsets = np.frombuffer(b"abcabd", np.uint8), np.array([0, 3, 6])
    table = context_mixing.count_bits(data, offsets, np.array([5, 2])).view(Counts)
    mixer = context_mixing.Mixer()
    context_mixing.train_mixer(mixer, table, np.array([7, 8], np.uint64), np.array([5, 2]), data, offsets, 0)
    assert mixer.bits[0].sum() > 0


def test_a_chunks_counts_are_kept_in_few_bytes():
    """Counts of a chunk's tokens were held in 8 bytes each, 44 bytes a token in all; what is read from them is the same."""
    rng = np.random.default_rng(12)
    n, words, texts = 300_000, 5_000, 300
    at = rng.integers(1, words, n)
    used = np.bincount(at, minlength=words)
    used[0] = texts
    counts, pairs, triples = rng.integers(0, 70_000, words), rng.integers(0, 300, n + texts), rng.integers(0, 9, n + texts)
    pack = context_mixing._pack_ints
    r = {"tokens": pack(context_mixing._ranks(used)[at]), "used": pack(used), "first": np.arange(0, n + 1, n // texts).tobytes(), "held": (np.arange(texts) % 7 == 2).tobytes(),
         "counts": pack(counts), "logs": context_mixing._pack_floats(-rng.random(words)), "pairs": pack(pairs), "triples": pack(triples)}
    tracemalloc.start()
    s = context_mixing.Spans(r, True)
    assert tracemalloc.get_traced_memory()[0] < 30 * n
    tracemalloc.stop()
    for k, (count, context) in enumerate(((pairs, context_mixing.before(counts[s.at], s.starts, counts[0])), (triples, context_mixing.before(pairs, s.starts, counts[0])))):
        seen, gate = s.order(k, slice(0, len(at) + texts))
        count, context = count - s.train, context - s.train
        assert (seen == np.where(context > 0, count / np.maximum(1, context), 0)).all()
        assert (gate == np.where(context > 0, 1 + np.log2(np.maximum(1, context)).astype(int), 0)).all()

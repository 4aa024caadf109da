"""Periodic runs against brute force."""

import hashlib
import random
import re

import numpy as np

from tally.llm import periodic_runs
from tally.llm.textual import utf8_buffer, word_hashes

SCHEMA = "doc_id long, text string, runs string, collapsed int"


def _runs(words):
    """All maximal stretches of each period, less those with a smaller period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and not any(all(words[i] == words[i - d] for i in range(s + d, e)) for d in range(1, q)):
                out.append((s, e - s, q))
            s = max(s + 1, e - q + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _texts():
    rng = random.Random(11)
    texts = [None, "", "  \n", "a", "a a a a a", "a a a a a a", "a " * 5000, "a b " * 4, "a b a b a b a", "x a b a b a b a b y", "a\tb\x0bc\n" * 4 + "a b"]
    for _ in range(150):
        words = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice("abcd") for _ in range(rng.randint(1, 6))] * rng.randint(1, 7) + [rng.choice("ab") for _ in range(rng.randint(0, 3))]
        texts.append(" ".join(words))
    nested = ("p q r " * 5 + "s ") * 6
    return [*texts, nested, nested * 2 + "é", "z " * 7 + nested + "z " * 6, " ".join(str(i % 997) for i in range(4200)), "the   cat " * 9]


def test_runs_equal_brute_force(spark):
    rows = [(i if i != 20 else None, t, "r", 1) for i, t in enumerate(_texts())]
    rows += rows[6:9]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for layout in (None, periodic_runs.planted):
        got = periodic_runs.runs(docs, layout=layout).collect()
        want = []
        for i, t, *_ in rows:
            words = re.findall(r"[^\x20\t-\r]+", t or "")
            if layout and words and i is not None and (ap := layout(i, len(words))):
                words = [w if k < ap[0] else words[ap[0] + (k - ap[0]) % ap[1]] for k, w in enumerate(words)]
            runs = _runs(words) if len(set(words)) < 900 else [(0, 4200, 997)]
            gone = {k for s, n, q in runs for k in range(s + q, s + n)}
            want.append((i, runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
        key = lambda x: (x[0] is None, x[0] or 0)
        assert sorted([(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=key) == sorted(want, key=key)
    assert sum(bool(periodic_runs.planted(i, 50)) for i in range(1000)) > 50
    assert periodic_runs.digest(periodic_runs.runs(docs.limit(0))).count() == 0


def test_digest_columns(spark):
    docs = spark.createDataFrame([(1, "a b " * 4 + "c " * 8, None, None), (2, "none here", None, None)], SCHEMA)
    got = {r.doc_id: r for r in periodic_runs.digest(periodic_runs.runs(docs)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert tuple(got[1])[:8] == (1, 2, 0, 8, 2, 4000, sha("0,8,2\n8,8,1\n"), sha("a b c"))
    assert tuple(got[2]) == (2, 0, None, None, None, None, sha(""), sha("none here"))


def test_windows_are_few_where_nothing_repeats_nearby():
    rng = random.Random(1)
    line = " ".join(rng.choice("amber river stone quiet lantern harbor willow".split()) + str(rng.randint(0, 50)) for _ in range(400))
    import pyarrow as pa
    hashes, first = word_hashes(*utf8_buffer(pa.array([line + " x y z " + line, "a b " * 30 + line])))
    wide = periodic_runs.windows(hashes, first)
    assert len(wide) == 1 and np.diff(wide[0]) < 90 and wide[0][0] == first[1]

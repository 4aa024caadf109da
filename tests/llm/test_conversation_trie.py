"""List ranking and the conversation trie against brute force."""

import hashlib
import random
import zlib

import pytest

from tally.llm import conversation_trie, list_ranking

SCHEMA = "conv_id long, turn int, role string, text string, depth string, next_out int"


@pytest.mark.parametrize("parts, base", [(1, 1 << 16), (7, 24)])
def test_positions_of_scattered_lists(spark, parts, base):
    rng = random.Random(9)
    items = [(a, b) for a in range(30) for b in range(4)]
    rng.shuffle(items)
    lists = [items[:1], items[1:40], items[40:]]
    rows = [(*x, *(y if y else (None, None))) for part in lists for x, y in zip(part, [*part[1:], None])]
    links = spark.createDataFrame(rows, "a long, b long, next_a long, next_b long").repartition(3)
    got = {(r.a, r.b): r.position for r in list_ranking.rank(links, ["a", "b"], parts, base).collect()}
    assert got == {x: i for part in lists for i, x in enumerate(part)}
    assert list_ranking.rank(links.limit(0), ["a", "b"], parts, base).count() == 0


def _trie(rows):
    turns = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    convs = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {n: sum(1 for x in members if len(x) == len(n) + 1 and x[:-1] == n) for n in members}
    out = []
    for n, cs in members.items():
        below = [x for x in members if x[:len(n)] == n]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(convs[c]) == len(n)))
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), kids[n], sum(not kids[x] for x in below), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie_equals_brute_force(spark):
    rng = random.Random(2)
    said = ["hi", "héllo", "", None, "more", "x" * 5000]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(said), "d", 1) for c in range(60) for t in range(rng.randint(1, 12))]
    rows += [(100 + c, t, "user", "same", None, 0) for c in range(80) for t in range(10)]  # copies: one path with many ends
    rows += [(7, None, "user", "first", None, None), (7, 3, "user", "tie", None, None), (7, 3, "user", "tie", None, None),
             (None, 1, "user", "nobody", None, None), (9_000_000_003, 0, "user", "gone", None, None)]
    rows += [(500, t, "user", str(t % 3), None, None) for t in range(400)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r) for r in conversation_trie.trie(d, 9, 256).collect()]
    assert sorted(got, key=str) == _trie(rows)


def test_empty_table(spark):
    assert conversation_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0

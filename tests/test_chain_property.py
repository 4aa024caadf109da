"""walk_chain equals a brute-force recursive walk when start times are distinct."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tally.operators.chain import walk_chain

BASE = dt.datetime(2024, 1, 1)


def _data(seed: int):
    rnd = random.Random(seed)
    rows = []
    for user in range(12):
        n = rnd.randint(1, 9)
        times = sorted(rnd.sample(range(0, 400), n))
        starts = [BASE + dt.timedelta(days=t) for t in times]
        for i, s in enumerate(starts):
            # usually LEAD-linked; sometimes a broken link (end moved)
            end = starts[i + 1] if i + 1 < n else BASE + dt.timedelta(days=500)
            if rnd.random() < 0.15:
                end = end + dt.timedelta(hours=1)
            rows.append((user, i + 1, s, end))
    return rows


def _brute(rows, anchor_from, depth):
    out = set()
    by_user = {}
    for u, seq, s, e in rows:
        by_user.setdefault(u, []).append((seq, s, e))
    for u, rs in by_user.items():
        rs.sort()
        first = rs[0]
        if first[0] != 1 or first[1] < anchor_from:
            continue
        step, cur = 1, first
        out.add((u, 1, cur[1]))
        while step < depth:
            nxt = [r for r in rs if r[1] == cur[2]]
            if not nxt:
                break
            step, cur = step + 1, nxt[0]
            out.add((u, step, cur[1]))
    return out


def test_walk_chain_matches_recursion(df):
    for seed in range(3):
        rows = _data(seed)
        d = df(rows, "user_id long, event_seq long, period_start timestamp_ntz, "
                     "period_end timestamp_ntz")
        anchor = BASE + dt.timedelta(days=50)
        got = walk_chain(d, "user_id", "event_seq", "period_start", "period_end",
                         anchor=F.col("period_start") >= F.lit(anchor).cast("timestamp_ntz"),
                         max_depth=5)
        have = {(r["user_id"], r["period_seq"], r["period_start"]) for r in got.collect()}
        assert have == _brute(rows, anchor, 5)

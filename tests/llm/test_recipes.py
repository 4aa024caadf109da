"""Exact dedup by chunk recipes against plain grouping of the normalised texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tally.llm import recipes

SCHEMA = "doc_id long, text string, kept boolean, _row string, keep_id string"


def _rows():
    rng = random.Random(5)
    long = " ".join(rng.choice(["sold", "led", "amber", "été", "дом", "river"]) + str(rng.randint(0, 99)) for _ in range(20_000))
    base = [" ".join(rng.choice("the of and doe sold else amber".split()) for _ in range(n)) for n in (1, 40, 300, 900)]
    texts = [*base, base[2].replace(" ", "\n\t"), base[2] + "  ", base[2] + "x", "x" + base[3], None, "", " \x0b\x0c", " ", "a" * 9000, "a" * 8999, long, long + " "]
    out = [(i, t, None, "r", str(i)) for i, t in enumerate(texts)]
    return out + [(None, base[1], True, None, None), (None, base[1], True, None, None), out[1], out[1], (77, base[0], None, None, None), (-5, base[0], None, None, None)]


def _norm(t):
    return re.sub(r"[\x20\t-\r]", "", t or "")


def _expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(_norm(r[1]), []).append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(members), hashlib.sha256(norm.encode()).hexdigest()) for r in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("identifier", [F.xxhash64, lambda c: F.length(c).cast("long"), lambda c: F.lit(7).cast("long") + F.length(c) * 0])
def test_groups_equal_brute_force_even_when_identifiers_collide(spark, identifier):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = recipes.exact_duplicates(docs, identifier=identifier).collect()
    want, groups = _expected(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == want
    assert sum(r.kept for r in got) == groups and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_deduplicate_keeps_one_whole_row_of_each_group(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = recipes.deduplicate(docs)
    assert left.columns == docs.columns
    got = [tuple(r) for r in left.collect()]
    assert len(got) == _expected(rows)[1] == len({_norm(r[1]) for r in got}) and set(got) <= set(rows)
    assert recipes.deduplicate(docs.limit(0)).count() == 0 and recipes.exact_duplicates(docs.limit(0)).count() == 0


def test_chunks_rejoin_and_find_their_cuts_again_after_an_insertion(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("sold else dozen zebra lodz".split()) for _ in range(4000))
    moved = text[:500] + "QQQ" + text[500:]
    a, b = [r.c for r in spark.createDataFrame([(0, text), (1, moved)], "i int, t string").orderBy("i").select(recipes.chunks(F.col("t")).alias("c")).collect()]
    assert "".join(a) == text and "".join(b) == moved and all(len(x) >= recipes.MIN_CHUNK for x in a[:-1])
    assert len(set(a) & set(b)) >= len(a) - 4

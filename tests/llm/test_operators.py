"""Small-table tests of the corpus operators: edge rows, and brute-force versions of the results."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm import context_mixing, graph, html_text, mixing, near_dedup, neighbours, packing, privacy, quality, repeats, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string"
WORDS = "the of and amber river stone quiet lantern harbor willow copper meadow thunder velvet garden silver".split()


def _text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "a", "el", "ion"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = [_text(rng, 120) for _ in range(8)]
    near = base[0].split()
    near[50] = "changed"
    texts = [*base, base[0], base[0], " ".join(near), None, "", "  \n\t ", "one", "two words", "the " * 300,
             _text(rng, 20_000), "# $ % " * 80, base[3] + "\n" + base[4]]
    out = [(i, t, [None, "en", "xx"][i % 3], [None, "a", "b"][i % 3], None, True, "x") for i, t in enumerate(texts)]
    return out + [(None, base[5], "en", "a", 1, None, None), out[1], out[1]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return re.findall(r"[^\x20\t-\r]+", t or "")


def test_quality_matches_brute_force(docs, empty, rows):
    got = quality.judge(docs).collect()
    assert len(got) == len(rows)
    want = {}
    for doc_id, t, *_ in rows:
        w = words(t)
        grams = {}
        for i in range(len(w) - 2):
            grams.setdefault(tuple(w[i:i + 3]), []).append(i)
        rep = {p + k for at in grams.values() if len(at) > 1 for p in at for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want[doc_id] = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep),
                        len(w) < 50 or 100 * len(rep) > 50 * len(w))
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]
        assert r.kept in ((False,) if r.base_failed else (True, False))
    assert quality.judge(empty).count() == 0


def test_quality_keeps_clean_text_of_any_language(spark):
    rng = random.Random(4)
    cyrillic = ["".join(rng.choice("абвгдежзиклмнопрстуф") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    clean = lambda forms: " ".join(rng.choice(forms) for _ in range(90)) + "."
    latin = [w + e for w in WORDS for e in ("", "a", "el", "ion", "ing", "er")]
    rows = [(i, clean(latin), "en") for i in range(30)] + [(100 + i, clean(cyrillic), "ru") for i in range(5)] + [(200, clean(cyrillic), None)]
    junk = " ".join(str(rng.randint(10**5, 10**9)) for _ in range(30_000))
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows + [(300, junk, "en")], "doc_id long, text string, lang string")).collect()}
    assert [i for i, r in got.items() if not r.kept] == [300]
    assert got[200].char_distance is None and got[100].word_distance is None


def _components(rows, width, percent):
    sets = []
    for doc_id, t, *_ in rows:
        w = [x.decode() for x in (t or "").encode().lower().split()]
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                both = len(sets[i] & sets[j])
                if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return out


def test_near_duplicates_match_brute_force(docs, empty, rows):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, 3, 85).collect()]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(_components(rows, 3, 85), key=key)
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id in (8, 9, 10)").count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    nodes = [int(x) for x in np.random.default_rng(2).permutation(4000)[:400]]
    edges = spark.createDataFrame(list(zip(nodes[:300], nodes[1:300])) + list(zip(nodes[300:], nodes[301:])), "a long, b long")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {x: min(part) for part in (nodes[:300], nodes[300:]) for x in part}


def test_sketch_bound_and_bands():
    for percent in (80, 85):
        r = near_dedup.band_rows(percent / 100)
        assert (1 - (percent / 100) ** r) ** (near_dedup.SAMPLES // r) < 1e-6


def test_spans_match_plain_patterns(spark, empty):
    texts = ["mail a.b@c.example.com, x@y.z.w. @a.b a@b 1.2.3.4.5.6.7.8 999.1.1.1 10.0.0.255",
             "4111 1111 1111 1111 and 4111-1111-1111-1112 +1 (555) 123-4567 +12", None, "", "é+33 1 23 45 67 89 password=9a8b7c6d5e4f3a2b1c0d", "a" * 50_000 + "1" * 50_000]
    d = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(texts)], DOCS)
    scanned = privacy.scan(d)
    got = {r.doc_id: r for r in privacy.digest(privacy.spans(scanned, privacy.train(scanned))).collect()}
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for i, t in enumerate(texts[:5]):
        found = []
        for k, (kind, p) in enumerate(pats.items()):
            for m in re.finditer(p, t or ""):
                digits = re.sub("[^0-9]", "", m.group())
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                        "card": 14 <= len(digits) <= 19 and privacy.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                    found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
        assert got[i].base_sha256 == hashlib.sha256(",".join(x for _, _, x in sorted(found)).encode()).hexdigest()
    clean = {r.doc_id: r for r in privacy.masked(d, privacy.train(scanned)).collect()}
    assert "@" not in clean[0].text.split("@a.b")[0] and clean[2].text is None and clean[1].text.startswith("<CARD>")
    assert privacy.train(privacy.scan(empty)) is not None


def test_labeler_reliability_recovers_truth():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth).astype(int) for a in (0.95, 0.8, 0.8, 0.6)], 1)
    patterns, back = np.unique(votes, axis=0, return_inverse=True)
    post, rely = privacy.estimate(patterns, np.bincount(back.ravel()).astype(float))
    assert ((post > 0.5)[back.ravel()] == truth).mean() > 0.93 and rely[0] > rely[3]


def test_page_text(spark):
    page = ("<html><head><title>x</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
            "<article><h1>A &amp; B</h1><p>Some  text,\nwith words. More of it here.</p><p>Second one, quite long too.</p></article>"
            "<footer>&copy; site</footer></body></html>")
    pages = spark.createDataFrame([(1, "u", page), (2, None, page), (2, None, page), (3, "v", None), (4, "w", ""), (5, "x", "<p>broken <b>mark"), (None, "y", page)],
                                  "page_id long, url string, html string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(pages, html_text.train(pages)).collect()]
    want = "A & B\nSome text, with words. More of it here.\nSecond one, quite long too."
    assert [x for x in got if x[0] in (1, 2, None)] == [(k, want, len(want)) for k in (1, 2, 2, None)]
    assert [x[1:] for x in got if x[0] in (3, 4)] == [("", 0)] * 2
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).count() == 0


def test_body_behind_an_open_head_and_inline_sorts_are_read():
    seen = lambda page: {n.tag: "".join(x for x in n.items if isinstance(x, str)) for n in html_text.elements(html_text.parse(page))}
    for body in ("<body><article><p>Some text.</p></article>", "<article><p>Some text.</p></article>", "\n<div><p>Some text.</p></div>"):
        assert seen("<html><head><title>x</title><meta charset=utf-8><script>1</script>" + body)["p"] == "Some text."
    assert "loose words" in seen("<html><head><title>x</title> loose words")["html"]
    assert "head" not in seen("<html><head><title>x</title><template><p>no</p></template></head><body>b</body></html>")
    assert "p" not in seen("<html><head><title>x</title><template><p>no</p></template></head><body>b</body></html>")
    got = seen("<p>a <math><mi>x</mi></math> <object>b</object> <button>c</button></p>")
    assert (got["mi"], got["object"], got["button"]) == ("x", "b", "c")


def test_decoding_keeps_no_text_under_a_rejected_parent():
    nodes = html_text.elements(html_text.parse("<div><p>aaaa bbbb</p><div><p>cccc dddd</p></div></div>"))
    odds = np.array([1.0 if n.tag == "p" else -9.0 for n in nodes])
    odds[1] = 1.0
    kept = html_text.decode(nodes, odds)
    assert all(n.parent is None or id(n.parent) in kept for n in nodes if id(n) in kept)


def test_neighbours_recall_and_edges(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(600 + i, x[7].tolist()) for i in range(30)]
    rows += [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [1.0, None]), (704, [1.0, 2.0]), (None, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect()
    ids = np.array([r[0] for r in rows[:630]])
    unit = np.array([r[1] for r in rows[:630]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, 630, 50):
        s = unit @ unit[q]
        s[q] = -9
        best = ids[np.lexsort((ids, -s.round(12)))[:5]]
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == ids[q])
        assert [o[0] for o in own] == [1, 2, 3, 4, 5]
        assert all(abs(o[2] - s[o[1]]) < 1e-12 for o in own)
        hits += len({o[1] for o in own} & set(best.tolist()))
        total += 5
    assert hits / total >= 0.9
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbour_search_ends_when_nothing_is_left_to_open(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 200)
    x = np.random.default_rng(6).normal(size=(4000, 32))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").withColumn("node", F.col("id"))
    nodes = neighbours.staged(neighbours.nodes_of(rows), "nodes")
    graph = neighbours.build(nodes)
    again = neighbours.descend(graph, nodes, 2)
    assert again.join(graph, ["u", "v"], "left_anti").count() <= 2 * 0.001 * 4000 * neighbours.K
    beam = neighbours.walk(nodes.filter("node % 200 = 0"), graph, nodes).toPandas()
    assert beam.opened.all() and (beam.groupby("q").size() == neighbours.BEAM).all()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = sum(len(set(np.argsort(-unit @ unit[q])[:6]) & set(own.v)) for q, own in beam.groupby("q"))
    assert hits >= 0.95 * 6 * 20


def test_toxicity_held_out(spark, docs, empty):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        rows.append((i, _text(rng, 60) + (" you idiot fool" if toxic else ""), None, None, None, None, None))
        labels.append((i, int(toxic)))
    d, l = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(None, 1), (9999, None)], "doc_id long, toxic int")
    out = toxicity.judge(d.union(docs.filter("doc_id is null or text is null")), l).collect()
    test = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert test and all((r.doc_id % 5 == 0) == (r.predicted == 1) for r in test)
    assert all(0 <= r.score <= 1 for r in out)
    assert toxicity.judge(empty, l.limit(0)).count() == 0


def test_context_mixing_counts_and_probability(docs, empty, rows):
    import zlib
    got = context_mixing.score(docs).collect()
    toks = [(r[0], [*(r[1] or "").encode().lower().split(), b""]) for r in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = {}
    for i, t in toks:
        for w in t if not held(i) else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = {i: (held(i), len(t), sum(w in counts for w in t), n, sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in t)) for i, t in toks}
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4]) and r.score < 0
    assert context_mixing.score(empty).count() == 0


def test_context_mixing_reads_words_in_order(spark):
    rng = random.Random(8)
    phrases = [[rng.choice(WORDS) + rng.choice(["", "a", "el", "ion"]) for _ in range(6)] for _ in range(20)]
    text = lambda: [w for _ in range(15) for w in rng.choice(phrases)]
    whole = [text() for _ in range(120)]
    rows = [(i, " ".join(t)) for i, t in enumerate(whole)] + [(1000 + i, " ".join(rng.sample(t, len(t)))) for i, t in enumerate(whole[:20])]
    held = (F.col("doc_id") < 20) | (F.col("doc_id") >= 1000)
    got = {r.doc_id: r for r in context_mixing.score(spark.createDataFrame(rows, "doc_id long, text string"), held).collect()}
    assert len(got) == 140
    for i in range(20):
        assert got[i].base_score == pytest.approx(got[1000 + i].base_score)
        assert got[i].score > got[1000 + i].score + 50


def test_span_keys():
    at, starts = np.array([1, 2, 1, 2, 0, 1, 2, 0]), np.array([0, 5])
    distinct, pair, triple = context_mixing.span_keys(at, starts, np.array([0, 11, 12], np.uint64))
    assert pair[0] == pair[5] and pair[1] == pair[3] == pair[6] and pair[4] == pair[7] and len(set(pair)) == 4
    assert triple[0] == triple[5] and triple[1] == triple[6] != triple[3] and triple[4] == triple[7] and len(set(triple)) == 5
    assert (context_mixing._unpack_sorted(context_mixing._pack_sorted(distinct)) == distinct).all() and len(distinct) == 9


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_match_brute_force(docs, empty, rows, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_CLASS", hot)
    texts = [(r[1] or "").encode() for r in rows]
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - 399):
            seen.setdefault(t[p:p + 400], []).append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for at in seen.values():
        if len(at) > 1:
            for i, p in at:
                gone[i][p:p + 400] = True
    want = {}
    for r, t, g in zip(rows, texts, gone):
        kept = np.frombuffer(t, np.uint8)[~g].tobytes()
        want[r[0]] = (len(t), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    got = repeats.repeats(docs, 400).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert repeats.repeats(empty).count() == 0


def test_repeated_starts_of_a_large_class_are_exact(monkeypatch):
    # a byte to the left and a place in the order that trade values are no repeat
    m, lefts = 200, [b"z"] * 200
    lefts[98], lefts[99] = b"b", b"a"
    out = repeats.repeated_starts([b""] * m, lefts, [201] * m, [0] * m, [1] * m, 400)
    assert not any(x.any() for x in out)
    # the same marks as by comparing all pairs
    rng = random.Random(3)
    for _ in range(30):
        m, length = rng.randint(13, 60), 6
        suffixes = sorted("".join(rng.choice("ab") for _ in range(rng.randint(2, 6))).encode() for _ in range(m))
        lefts = ["".join(rng.choice("cd") for _ in range(rng.randint(0, 4))).encode() for _ in range(m)]
        shared = [0, *(repeats.common_prefix(a, b, 0) for a, b in zip(suffixes[:-1], suffixes[1:]))]
        high = [len(x) for x in lefts]
        low = [rng.randint(0, h) for h in high]
        many = repeats.repeated_starts(suffixes, lefts, shared, low, high, length)
        with monkeypatch.context() as patch:
            patch.setattr(repeats, "PAIRWISE", m)
            pairs = repeats.repeated_starts(suffixes, lefts, shared, low, high, length)
        assert [x.tolist() for x in many] == [x.tolist() for x in pairs]


def test_repeats_put_out_the_kept_text(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("bcdfgaeiou") for _ in range(n))
    prose = lambda n: " ".join(word(rng.randint(6, 9)) for _ in range(n))
    passage, heads, tails = prose(60), [prose(30) + " 1", prose(30) + " 2"], ["x " + prose(30), "y " + prose(30)]
    rows = [(1, heads[0] + passage + tails[0]), (2, heads[1] + passage + tails[1]), (3, prose(90)), (4, None),
            (5, "é" + "ab" * 300), (6, "è" + "ab" * 300)]
    got = {r.doc_id: r for r in repeats.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == [heads[0] + tails[0], heads[1] + tails[1], rows[2][1], ""]
    assert [(got[i].n_removed, got[i].text) for i in (5, 6)] == [(600, "é"), (600, "è")]
    assert hashlib.sha256(got[1].text.encode()).hexdigest() == got[1].kept_sha256
    # of a character cut in two, the first byte alone is no text
    cut = [(1, "a" * 10 + "é" + passage), (2, "b" * 10 + "ĩ" + passage)]
    assert "é".encode()[1:] == "ĩ".encode()[1:]
    got = {r.doc_id: r for r in repeats.repeats(spark.createDataFrame(cut, "doc_id long, text string")).collect()}
    assert [(got[i].n_bytes - got[i].n_removed, got[i].text) for i in (1, 2)] == [(11, "a" * 10), (11, "b" * 10)]


def test_merge_orders_runs_and_prefixes():
    rng = random.Random(1)
    lists = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 9))).encode() for _ in range(rng.randint(0, 30))) for _ in range(5)]
    runs = []
    for x in lists:
        shared, rests = repeats.front_code(x)
        runs.append(repeats.Run(shared, np.array([len(s) for s in x], np.int32), rests))
    out = list(repeats.merge(runs))
    assert [s for _, _, s, _ in out] == sorted(s for x in lists for s in x)
    for (_, _, a, _), (_, _, b, k) in zip(out[:-1], out[1:]):
        assert k == repeats.common_prefix(a, b, 0)


def test_mix_meets_targets(docs, empty, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    total = sum(len(words(r[1])) for r in rows)
    assert sum({(r.source, r.target) for r in got} and {r.source: r.target for r in got}.values()) == pytest.approx(1.5 * total)
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1 and own[0].target <= 2 * own[0].source_size
        assert all(0 <= r.taken <= 2 * r["size"] for r in own)
    taken = mixing.training_documents(docs)
    assert taken.columns == docs.columns
    assert sum(len(words(r.text)) for r in taken.collect()) == sum(r.taken for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.training_documents(empty).count() == 0


def test_packing_places_every_id_once(docs, empty, rows):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack_documents(docs).collect()
    want = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want += [(r[0], k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes()), len(ids)) for k in range(0, len(ids), 4096)]
    key = lambda x: (x[0] is None, x)
    strip = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got]
    assert sorted(map(str, strip)) == sorted(map(str, want)) and key
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    assert packing.pack_documents(empty).count() == 0


def test_fill_is_the_best_subset():
    import itertools
    rng = random.Random(2)
    for _ in range(50):
        xs = [rng.randint(1, 40) for _ in range(8)]
        room = rng.randint(5, 100)
        best = max(s for k in range(9) for c in itertools.combinations(xs, k) if (s := sum(c)) <= room)
        used = packing.fill({x: xs.count(x) for x in xs}, room)
        assert sum(used) == best and all(used.count(x) <= xs.count(x) for x in used)

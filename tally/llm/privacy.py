"""Personal data by weak supervision.

Four regular kinds (email, ip, card, phone) are found exactly. Further spans
come from candidate tokens (runs with a digit or a key-like assignment, outside
the regular kinds), on which labelers vote yes, no or abstain: shape patterns,
a gazetteer of credential words, and the words around the candidate. Votes are
counted per pattern over the whole corpus; expectation-maximisation on those
counts (at most 3 ** labelers rows) estimates each labeler's reliability and
each pattern's posterior. A logistic span classifier is fitted to the
posteriors, again on pattern counts, so its training sees every candidate and
its cost does not grow with the corpus. The classifier decides each span.

Offsets are code points, ends exclusive. Edge cases. Null and empty texts have
no spans. Null or repeated ids and repeated rows: each row is scanned alone.
Without any candidate nothing is added. Empty table: empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tally.llm.textual import utf8_buffer

KINDS = ("email", "ip", "card", "phone", "secret")

# The patterns of the four regular kinds. Possessive runs keep the search linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the run of its characters before an at sign."""
    low = 0
    at = text.find("@")
    while at >= 0:
        s = at
        while s > low and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        m = _DOMAIN.match(text, at) if s < at else None
        if m:
            yield s, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


REGULAR = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def regular_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then by the order of the kinds."""
    found = [(s, e, kind) for kind, find in REGULAR.items() for s, e in find(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


# Candidates: runs of key characters that hold a digit.
_VALUE = re.compile(r"[A-Za-z0-9+/_-]{8,}")
# Gazetteer of credential words and of words that announce a version or a licence.
CREDENTIAL_WORDS = frozenset("password passwd pwd secret token apikey api_key key auth bearer credential login".split())
PUBLIC_WORDS = frozenset("version license licence copyright page chapter isbn issue section".split())
_KEY_SHAPE = re.compile(r"(?:AKIA|ASIA|ghp_|sk-|xox[bp]-)[A-Za-z0-9_-]{8,}")
_HEX = re.compile(r"[0-9a-f]{12,}|[0-9A-F]{12,}")


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, tuple[int, ...]]]:
    """(start, end, votes) of key-like runs outside the spans taken."""
    out, busy = [], iter(taken + [(len(text) + 1, len(text) + 1, "")])
    block = next(busy)
    for m in _VALUE.finditer(text):
        s, e = m.span()
        while block[1] <= s:
            block = next(busy)
        if block[0] < e or not any(c.isdigit() for c in m.group()):
            continue
        out.append((s, e, votes(text, s, e)))
    return out


def votes(text: str, s: int, e: int) -> tuple[int, ...]:
    """Each labeler's vote on text[s:e]: 1 yes, 0 no, -1 abstains."""
    run = text[s:e]
    before = text[max(0, s - 60):s].lower()
    words = re.findall(r"[a-z_]+", before)
    kinds = sum(any(f(c) for c in run) for f in (str.islower, str.isupper, str.isdigit))
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(run, run[1:]))
    return (
        1 if _KEY_SHAPE.fullmatch(run) else -1,                                        # pattern: known key prefix
        1 if _HEX.fullmatch(run) and changes >= 4 else 0 if run.isdigit() else -1,     # pattern: hexadecimal
        1 if CREDENTIAL_WORDS & set(words[-2:]) else 0 if PUBLIC_WORDS & set(words[-2:]) else -1,  # gazetteer
        1 if re.search(r"[=:]\s?\"?\Z", before) else -1,                               # context: assigned
        1 if changes >= 4 and len(run) >= 12 else 0 if changes <= 2 else -1,           # shape: mixed
        1 if kinds >= 2 and len(run) >= 16 else 0 if len(run) < 10 else -1,            # shape: length and alphabet
    )


N_LABELERS = 6


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, regular (kind:start:end list), and the candidates with their votes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(256, bool)
        mark[list(b"0123456789@")] = True
        for batch in batches:
            raw, offsets = utf8_buffer(batch.column("text"))
            marked = np.concatenate([[0], np.cumsum(mark[raw])])
            busy = np.flatnonzero(marked[offsets[1:]] > marked[offsets[:-1]])  # texts without digit and @ hold nothing
            regular, cands = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for i in busy.tolist():
                text = raw[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
                spans = regular_spans(text)
                regular[i] = [{"start": s, "end": e, "kind": k} for s, e, k in spans]
                cands[i] = [{"start": s, "end": e, "votes": list(v)} for s, e, v in candidates(text, spans_cover(spans))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(regular, _REGULAR), pa.array(cands, _CANDS)],
                names=["doc_id", "regular", "candidates"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, regular array<struct<start: int, end: int, kind: string>>, "
             "candidates array<struct<start: int, end: int, votes: array<int>>>")


_REGULAR = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_CANDS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("votes", pa.list_(pa.int32()))]))


def spans_cover(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans joined where they overlap, by start."""
    out: list[tuple[int, int, str]] = []
    for s, e, k in spans:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]), "")
        else:
            out.append((s, e, k))
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: (posterior per pattern, reliability per labeler).

    Each labeler votes right with its own reliability, whatever the others do;
    an abstention says nothing. Starts from the majority of the votes.
    """
    cast, yes = patterns >= 0, patterns == 1
    post = (yes.sum(1) + 0.5) / (cast.sum(1) + 1.0)
    for _ in range(rounds):
        prior = np.clip((counts * post).sum() / counts.sum(), 0.01, 0.99)
        right = np.where(yes, post[:, None], 1 - post[:, None]) * cast * counts[:, None]
        rely = (right.sum(0) + 4.0) / ((cast * counts[:, None]).sum(0) + 5.0)
        rely = np.clip(rely, 0.55, 0.99)
        step = np.where(yes, 1, -1) * cast @ np.log(rely / (1 - rely))
        post = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + step)))
    return post, rely


def features(patterns: np.ndarray) -> np.ndarray:
    return np.concatenate([patterns == 1, patterns == 0, np.ones((len(patterns), 1))], axis=1).astype(float)


def fit_classifier(patterns: np.ndarray, counts: np.ndarray, post: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Logistic regression to the soft labels, weighted by counts (ridge, gradient steps)."""
    x, share = features(patterns), counts / counts.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 4.0 * (x.T @ (share * (p - post)) + 1e-4 * w)
    return w


def train(scanned: DataFrame) -> np.ndarray:
    """The classifier's weights, from the counts of all vote patterns of the corpus."""
    counted = (scanned.select(F.explode("candidates.votes").alias("votes")).groupBy("votes").count()).collect()
    if not counted:
        return np.zeros(2 * N_LABELERS + 1) - 1.0
    patterns = np.array([r["votes"] for r in counted])
    counts = np.array([r["count"] for r in counted], float)
    order = np.lexsort(patterns.T)
    patterns, counts = patterns[order], counts[order]
    post, _ = estimate(patterns, counts)
    return fit_classifier(patterns, counts, post)


def spans(scanned: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, regular, and added: the candidates the classifier takes, as kind secret."""
    taken = _pattern_table(weights)
    return scanned.select("doc_id", "regular", F.transform(
        F.filter("candidates", lambda c: F.concat_ws(",", F.transform(c["votes"], lambda v: v.cast("string"))).isin(taken)),
        lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit("secret").alias("kind"))).alias("added"))


def _pattern_table(weights: np.ndarray) -> list[str]:
    """All vote patterns (3 ** labelers) that the classifier takes."""
    grid = np.stack(np.meshgrid(*[[-1, 0, 1]] * N_LABELERS), -1).reshape(-1, N_LABELERS)
    keep = grid[features(grid) @ weights > 0]
    return [",".join(map(str, g)) for g in keep.tolist()] or [""]


def digest(found: DataFrame) -> DataFrame:
    """One row per document with counts by kind, the hash of the regular spans and all spans."""
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    ranked = F.transform(F.concat("regular", "added"), lambda x: F.struct(
        x["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    kinds = F.transform("regular", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("regular")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.sort_array(ranked)).alias("spans"), F.size("added").cast("long").alias("n_added"))


def masked(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The input's rows and columns with every span in ``text`` replaced by <KIND>; n_chars follows.

    Overlapping spans are replaced together, under the first one's kind.
    """
    taken = frozenset(_pattern_table(weights))

    def clean(text: str) -> str:
        found = regular_spans(text)
        more = [(s, e, "secret") for s, e, v in candidates(text, spans_cover(found)) if ",".join(map(str, v)) in taken]
        out, at, open_end = [], 0, -1
        for s, e, kind in sorted(found + more, key=lambda x: (x[0], KINDS.index(x[2]))):
            if s >= open_end:
                out += [text[at:s], f"<{kind.upper()}>"]
            at = open_end = max(e, open_end)
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            texts = batch.column(k).to_pylist()
            new = [t if t is None or not _MARK.search(t) else clean(t) for t in texts]
            batch = batch.set_column(k, batch.schema.field(k), pa.array(new, batch.schema.field(k).type))
            yield batch

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else out


_MARK = re.compile("[0-9@]")

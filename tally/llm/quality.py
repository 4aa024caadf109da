"""Quality rules by distribution divergence, in DataFrame expressions only.

Every document gets two histograms: its character classes and its common
words. Each is compared with the reference of the document's language (the
mean over the corpus' own documents of that language, each counting once) by Jensen-Shannon distance, the square root of
the divergence in bits, from 0 (same) to 1 (disjoint). Short documents have
noisy histograms, so a distance only counts from a minimum length on. Two
plain guards come first: too few words, and too large a share of words in
repeated three-word windows.

Edge cases. Null and empty text: no words, fails the word guard. A
language whose common words are not listed here: only the characters are
compared. Null language: no reference, so the distances are null and pass.
Repeated rows: each row is judged alone. Empty table: empty result. Columns of
the input named like a result column are replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tally.llm.stage import carried, carried_column, staged, with_results

SPACE = r"[\x20\x09-\x0D]+"
#: Symbols of the contract, and the classes' characters.
SYMBOLS = "#*$%&|<>"
CLASSES = {"upper": "A-Z", "digit": "0-9", "stop": r".,;:?'\"()\-", "symbol": r"#*$%&|<>@^~_=+/\\\[\]{}`", "bang": "!"}
#: Common words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "with", "by", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "sur"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una", "su"],
}

#: Parameters: guards and thresholds. A distance is used from so many words on.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_WORDS_CHARS = 50
MIN_WORDS_COMMON = 100
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.28


def _materialised(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns through a one-row generator, so that later lambdas read them as values
    and the optimiser does not inline (and so recompute) their expressions."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def _histograms(df: DataFrame) -> DataFrame:
    """From (_text, _lang): words, character-class counts and common-word counts."""
    df = df.withColumn("_text", F.coalesce("_text", F.lit("")))
    df = _materialised(df, _words=F.array_remove(F.split("_text", SPACE), ""),
                       _rest=F.regexp_replace("_text", r"[a-z\x20\x09-\x0D]+", ""))
    forms = sorted({x for words in COMMON_WORDS.values() for w in words for x in (w, w.capitalize())})
    df = _materialised(df, _common=F.lower(F.concat(F.lit(","), F.array_join(F.filter("_words", lambda w: w.isin(forms)), ",,"), F.lit(","))),
                       _word_chars=F.length(F.array_join("_words", "")).cast("long"))
    length, rest = F.length("_text"), F.length("_rest")
    df = _materialised(df, **{f"_n_{n}": rest - F.length(F.regexp_replace("_rest", f"[{c}]+", "")) for n, c in CLASSES.items()})
    per_class = {n: F.col(f"_n_{n}") for n in CLASSES}
    spaces = length - F.col("_word_chars")
    counts = {**per_class, "space": spaces, "lower": length - rest - spaces,
              "other": rest - sum(per_class.values())}
    return df.select("*", F.array(*[c.cast("double") for c in counts.values()]).alias("_chars"),
                     F.col("_lang").alias("_ref"), _word_histogram().alias("_hist"))


def _word_histogram() -> Column:
    """Counts of the language's common words, and of all words; null for other languages.

    _common holds the common words of all languages, each between two commas,
    so a word's count is the length that its removal takes away.
    """
    out = F.lit(None)
    for lang, words in COMMON_WORDS.items():
        n = [(F.octet_length("_common") - F.octet_length(F.replace("_common", F.lit(f",{w},"), F.lit("")))) / (len(w) + 2) for w in words]
        out = F.when(F.col("_lang") == lang, F.array(*n, F.size("_words").cast("double"))).otherwise(out)
    return out


def measure(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The input's columns (carried) with each document's counts and histograms; one pass, no shuffle."""
    df = carried(docs).select("*", carried_column(docs, text).alias("_text"), carried_column(docs, lang).alias("_lang"))
    df = _materialised(_repeat_words(_histograms(df)),
                       _lines=F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    symbols = F.length("_rest") - F.length(F.regexp_replace("_rest", f"[{SYMBOLS}]+", ""))
    return df.select(*[f"_in{i}" for i in range(len(docs.columns))], "_ref", "_chars", "_hist", "_word_chars", "_repeat",
                     F.size("_words").cast("long").alias("_n"), symbols.cast("long").alias("_symbols"),
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_dup"))


def language_references(measured: DataFrame) -> DataFrame:
    """One row per language value present, with the mean of its documents' histograms, each scaled
    to sum one: (ref, ref_chars, ref_words).

    A document counts once, however long, so a few long ones do not move the reference. Languages
    without common words here have a reference of characters alone; a null language has none.
    As many rows as language values, whatever the input; sums are combined before the shuffle.
    """
    n_c, n_w = len(CLASSES) + 3, max(map(len, COMMON_WORDS.values())) + 1
    whole = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    even = lambda c, n: F.when(F.col(n) > 0, F.transform(c, lambda x: x / F.col(n)))
    each = _materialised(measured.filter("_ref is not null").select("_ref", "_chars", "_hist"), _all_chars=whole("_chars"), _all_words=whole("_hist"))
    each = _materialised(each, _c=even("_chars", "_all_chars"), _w=even("_hist", "_all_words"))
    by_lang = each.groupBy("_ref").agg(*[F.avg(F.col("_c")[i]).alias(f"c{i}") for i in range(n_c)],
                                       *[F.avg(F.col("_w")[i]).alias(f"w{i}") for i in range(n_w)])
    return by_lang.select(F.col("_ref").alias("ref"), F.when(F.col("c0").isNotNull(), F.array(*[f"c{i}" for i in range(n_c)])).alias("ref_chars"),
                          F.when(F.col("w0").isNotNull(), F.array(*[f"w{i}" for i in range(n_w)])).alias("ref_words"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of count array ``p`` (any scale) and distribution ``q``."""
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(F.transform(p, lambda x: x / total), q,
                       lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    return F.when((total > 0) & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add _repeat: words inside three-word windows that occur twice or more in the text.

    Window hashes and positions are packed into one long and sorted; equal
    neighbours are confirmed on the words themselves, so a hash collision
    never counts. No shuffle, n log n per text.
    """
    last = F.size("_words") - 2
    df = _materialised(df, _bits=F.length(F.bin(F.size("_words"))), _h=F.transform("_words", lambda w: F.xxhash64(w)))
    df = _materialised(df, _packed=F.when(last > 0, F.expr(
        "sort_array(transform(sequence(0, size(_words) - 3), i -> "
        "shiftleft(xxhash64(_h[i], _h[i + 1], _h[i + 2]), _bits) | cast(i as bigint)))"))
        .otherwise(F.expr("cast(array() as array<bigint>)")))
    df = _materialised(df, _near=F.expr(
        "filter(_packed, (x, i) -> shiftright(x, _bits) = shiftright(get(_packed, i - 1), _bits) "
        "or shiftright(x, _bits) = shiftright(get(_packed, i + 1), _bits))"))
    df = _materialised(df, _equal=F.expr(
        "filter(zip_with(slice(_near, 1, greatest(size(_near) - 1, 0)), slice(_near, 2, size(_near)), (a, b) -> "
        "if(shiftright(a, _bits) = shiftright(b, _bits), "
        "array(cast(a & (shiftleft(1L, _bits) - 1) as int), cast(b & (shiftleft(1L, _bits) - 1) as int)), null)), "
        "x -> x is not null and _words[x[0]] = _words[x[1]] and _words[x[0] + 1] = _words[x[1] + 1] "
        "and _words[x[0] + 2] = _words[x[1] + 2])"))
    df = _materialised(df, _at=F.sort_array(F.array_distinct(F.flatten("_equal"))))
    return df.withColumn("_repeat", F.expr(
        "aggregate(_at, named_struct('end', 0, 'n', 0L), (s, p) -> named_struct('end', p + 3, "
        "'n', s.n + least(3, p + 3 - s.end)), s -> s.n)"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """The input's rows and columns (or those named in ``carry``) with the rule counts,
    distances and verdict: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, char_distance, word_distance, kept.

    The measured rows are staged, as both the references and the verdicts need
    them; the references (one small row per language value) are broadcast. No text is
    shuffled. A document without a reference, of a null language, passes the distances.
    """
    measured = measure(docs, text, lang)
    if carry is not None:
        docs, measured = _narrowed(docs, measured, carry)
    measured = staged(measured, "quality")
    df = measured.join(F.broadcast(language_references(measured)), F.col("_ref") == F.col("ref"), "left")
    df = _materialised(df, _char_distance=js_distance(F.col("_chars"), F.col("ref_chars")),
                       _word_distance=js_distance(F.col("_hist"), F.col("ref_words")))
    n = F.col("_n")
    failed = (n < MIN_WORDS) | (100 * F.col("_repeat") > MAX_REPEAT_PERCENT * n)
    far = (((n >= MIN_WORDS_CHARS) & (F.col("_char_distance") > MAX_CHAR_DISTANCE))
           | ((n >= MIN_WORDS_COMMON) & (F.col("_word_distance") > MAX_WORD_DISTANCE)))
    return with_results(df, docs, {
        "n_words": n, "word_chars": F.col("_word_chars"), "n_symbols": F.col("_symbols"), "n_dup_lines": F.col("_dup"),
        "n_repeat_words": F.col("_repeat"), "base_failed": failed, "char_distance": F.col("_char_distance"),
        "word_distance": F.col("_word_distance"), "kept": ~failed & ~F.coalesce(far, F.lit(False))})


def _narrowed(docs: DataFrame, measured: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    at = [docs.columns.index(c) for c in carry]
    own = [c for c in measured.columns if not c.startswith("_in")]
    return docs.select(*[F.col(f"`{c}`") for c in carry]), measured.select(*[F.col(f"_in{k}").alias(f"_in{i}") for i, k in enumerate(at)], *own)

"""Text helpers: term extraction (T1) and dictionary category match.

Terms are runs of letters, lower-cased, in text order with repeats, at least
``min_len`` long. A morphological analyser is not available, so ``tokenizer``
accepts any ``Column -> Column(array<string>)`` function instead (a built-in
expression or a pandas UDF).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNCATEGORIZED = "uncategorized"


def extract_terms(text: Column, min_len: int = 2,
                  tokenizer: Callable[[Column], Column] | None = None) -> Column:
    """array<string> of the terms of ``text`` (NULL text -> NULL)."""
    if tokenizer is not None:
        terms = tokenizer(text)
        return F.filter(terms, lambda t: F.length(t) >= min_len)
    pattern = r"\p{L}{%d,}" % min_len
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def match_categories(terms: Column, dictionary: Sequence[tuple[str, Sequence[str]]],
                     default: str = UNCATEGORIZED) -> Column:
    """Comma-joined categories (dictionary order) whose keywords meet ``terms``.

    Equal terms match, whatever the case of the keyword; ``default`` when
    nothing matches. One form for dictionaries of any size, inside one
    projection (no shuffle, no UDF): terms that are keywords (a hash set) are
    looked up in a map from keyword to category numbers.
    """
    numbers: dict[str, list[int]] = {}
    for i, (_, kws) in enumerate(dictionary):
        for k in kws:
            own = numbers.setdefault(k.lower(), [])
            if i not in own:
                own.append(i)
    if not numbers:
        return F.lit(default)
    by_word = F.create_map(*[c for k, v in numbers.items() for c in (F.lit(k), F.array(*map(F.lit, v)))])
    names = F.array(*[F.lit(cat) for cat, _ in dictionary])
    found = F.transform(F.filter(terms, lambda t: t.isin(list(numbers))), lambda t: by_word[t])
    hits = F.array_sort(F.array_distinct(F.flatten(found)))
    joined = F.array_join(F.transform(hits, lambda i: F.get(names, i)), ",")
    return F.when(F.coalesce(F.size(hits) == 0, F.lit(True)), F.lit(default)).otherwise(joined)

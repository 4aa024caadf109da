"""Column-level helpers: every function takes and returns ``Column``s."""

from tally.functions.numeric import guarded_pct, null_add, round_half
from tally.functions.text import extract_terms, match_categories
from tally.functions.time import as_date, as_timestamp, day_start_epoch, epoch_to_ts

__all__ = ["round_half", "guarded_pct", "null_add", "extract_terms", "match_categories",
           "as_date", "as_timestamp", "day_start_epoch", "epoch_to_ts"]

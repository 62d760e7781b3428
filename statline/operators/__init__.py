from statline.operators.aggregates import Measure, Rate, Ratio, add_derived, totals
from statline.operators.keys import duplicate_keys, keep_last, top_n_per_group
from statline.operators.links import (
    drop_orphans, keep_matching, lookup, mark_orphans, orphan_keys, orphan_rows,
)
from statline.operators.profile import label_census, null_profile, validity
from statline.operators.rules import Rule, RuleSet
from statline.operators.search import equals, range_filter
from statline.operators.upsert import breaks_contract, conform, split_contract, upsert

__all__ = [
    "Measure", "Rate", "Ratio", "Rule", "RuleSet", "add_derived", "breaks_contract", "conform", "drop_orphans",
    "duplicate_keys", "equals", "keep_last", "keep_matching", "label_census", "lookup", "mark_orphans", "null_profile",
    "orphan_keys", "orphan_rows", "range_filter", "split_contract", "top_n_per_group", "totals", "upsert",
    "validity",
]

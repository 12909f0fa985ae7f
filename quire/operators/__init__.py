"""DataFrame-to-DataFrame operators."""

from quire.operators.calendar import calendar, calendar_covering
from quire.operators.clean import clean, clean_by_metadata, pad_fixed, to_raw
from quire.operators.clustering import cluster_by, files_holding
from quire.operators.dedupe import collapse_report, keep_latest, latest_with_ties
from quire.operators.drilldown import drill_down
from quire.operators.evolve import read_evolved
from quire.operators.joins import join_dimension, orphan_keys, resolve_code
from quire.operators.keys import key_collisions, with_surrogate_key
from quire.operators.merge import replace_by_key, snapshot_diff, union_evolved, upsert
from quire.operators.profile import profile_columns
from quire.operators.vectors import cosine_topk

__all__ = [
    "calendar", "calendar_covering", "clean", "clean_by_metadata", "cluster_by",
    "collapse_report", "cosine_topk", "drill_down", "files_holding", "join_dimension", "keep_latest",
    "key_collisions", "latest_with_ties", "orphan_keys", "pad_fixed", "profile_columns", "read_evolved", "replace_by_key",
    "resolve_code", "snapshot_diff", "to_raw", "union_evolved", "upsert", "with_surrogate_key",
]

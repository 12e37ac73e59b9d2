from millrace.operators.changes import CHANGE_COLUMNS, change_rows, latest_per_key
from millrace.operators.groups import compare_to_group_avg, nth_highest
from millrace.operators.merge import merge
from millrace.operators.profile import in_range, null_counts

__all__ = [
    "CHANGE_COLUMNS",
    "change_rows",
    "compare_to_group_avg",
    "in_range",
    "latest_per_key",
    "merge",
    "nth_highest",
    "null_counts",
]

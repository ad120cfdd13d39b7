"""DataFrame operators; each takes column names, so it serves any table."""

from halfspace.operators.groups import (
    density,
    means_by,
    points_by,
    share_of_total,
    top_groups,
    total_and_mean_by,
)
from halfspace.operators.key_checks import Referenced, Unique, check_suite, key_check
from halfspace.operators.keys import first_listed, landing_counts, only_listed, unlanded_keys
from halfspace.operators.project import flatten
from halfspace.operators.quality import (
    AtLeastRows,
    InRange,
    NotNull,
    ObservedTally,
    QualityGateError,
    check,
    gate,
    judge,
    tally,
)
from halfspace.operators.rows import drop_incomplete, top_rows

__all__ = [
    "AtLeastRows",
    "InRange",
    "NotNull",
    "ObservedTally",
    "QualityGateError",
    "Referenced",
    "Unique",
    "check",
    "check_suite",
    "density",
    "drop_incomplete",
    "first_listed",
    "flatten",
    "gate",
    "judge",
    "key_check",
    "landing_counts",
    "means_by",
    "only_listed",
    "points_by",
    "share_of_total",
    "tally",
    "top_groups",
    "top_rows",
    "total_and_mean_by",
    "unlanded_keys",
]

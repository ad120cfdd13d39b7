"""Column functions."""

from halfspace.functions.documents import at_path, parse_json, safe_number
from halfspace.functions.exact import exact_mean, exact_sum, round_half_away
from halfspace.functions.presence import present

__all__ = [
    "at_path",
    "exact_mean",
    "exact_sum",
    "parse_json",
    "present",
    "round_half_away",
    "safe_number",
]

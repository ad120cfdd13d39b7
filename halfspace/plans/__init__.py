"""Plans: the trusted tables, the analytic queries and the medallion run."""

from halfspace.plans.analytics import (
    event_mix,
    home_standings,
    pass_density,
    shot_map,
    team_passing,
    team_xg,
    top_pressers,
)
from halfspace.plans.medallion import GROUPS, Lake, checked_batch, run, trusted_views
from halfspace.plans.trusted import checked_events, trusted_events, trusted_matches
from halfspace.plans.xg import NoModelError, XgModel, fit_xg, with_model_xg, xg_gradient

__all__ = [
    "GROUPS",
    "Lake",
    "NoModelError",
    "XgModel",
    "checked_batch",
    "checked_events",
    "event_mix",
    "fit_xg",
    "home_standings",
    "pass_density",
    "run",
    "shot_map",
    "team_passing",
    "team_xg",
    "top_pressers",
    "trusted_events",
    "trusted_matches",
    "trusted_views",
    "with_model_xg",
    "xg_gradient",
]

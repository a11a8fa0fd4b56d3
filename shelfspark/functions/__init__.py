"""Native column expressions shared by the jobs."""

from .bands import activity, cohort, recency
from .dates import (add_days, add_months, date_lit, day_boundaries, month_boundaries,
                    second_boundaries, ts_lit, week_boundaries)
from .joins import not_in
from .json import is_valid_json, json_path_text
from .urls import code_as_org_id, is_register_page, org_code, position_find

__all__ = [
    "activity", "cohort", "recency", "add_days", "add_months", "date_lit", "day_boundaries",
    "month_boundaries", "second_boundaries", "ts_lit", "week_boundaries", "not_in",
    "is_valid_json", "json_path_text", "code_as_org_id", "is_register_page", "org_code",
    "position_find",
]

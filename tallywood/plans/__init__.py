from tallywood.plans.ordered import (
    number_rows,
    number_within,
    running_first_last,
    running_sums,
)
from tallywood.plans.scratch import checkpoint_root, materialized, persisted, scratch_path
from tallywood.plans.shipping import shipped
from tallywood.plans.skew import HeavyKeys, find_heavy, heavy_among

__all__ = [
    "HeavyKeys",
    "checkpoint_root",
    "find_heavy",
    "heavy_among",
    "materialized",
    "number_rows",
    "number_within",
    "persisted",
    "running_first_last",
    "running_sums",
    "scratch_path",
    "shipped",
]

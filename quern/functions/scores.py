"""Score arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the 25 criteria, in order of their ids, each worth 10 points at most.
CRITERION_WEIGHTS = [
    1.2, 1.5, 1.0, 1.0, 1.1, 1.1, 1.2, 1.0, 1.0, 1.0, 1.3, 1.2, 0.8,
    0.7, 1.0, 1.1, 0.9, 0.8, 0.7, 0.8, 1.1, 1.0, 0.7, 1.0, 1.2,
]


def passes_score(score: Column, least: float = 80) -> Column:
    """A missing score counts as 0; NaN fails."""
    return F.coalesce((score >= least) & ~F.isnan(score), F.lit(False))


def checklist_score(scores: Column) -> Column:
    """Sum of 20 scores of at most 5, as a share."""
    return F.aggregate(scores, F.lit(0.0), lambda total, x: total + x) / 100


def composite_reward(not_repetitive: Column, has_page: Column, rendered: Column, s_chk: Column, s_sim: Column, s_len: Column) -> Column:
    """0 for repetition; similarity (weight 0.3) counts only for a page that was rendered."""
    shown = F.coalesce(has_page & rendered, F.lit(False))
    return F.when(~not_repetitive, 0.0).otherwise(0.6 * s_chk + F.when(shown, 0.3 * F.coalesce(s_sim, F.lit(0.0))).otherwise(0.0) + 0.1 * s_len)

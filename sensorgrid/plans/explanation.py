"""The explanation run: contributions of a sample, importance, and the strongest effects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sensorgrid.operators import explain
from sensorgrid.operators.boosting import load_model
from sensorgrid.operators.features import sample_n
from sensorgrid.plans.validation import store_result
from sensorgrid.session import cut_lineage

SAMPLE_ROWS = 100_000  # fixed value


@dataclass
class Explanation:
    contributions: DataFrame
    importance: DataFrame
    by_group: DataFrame
    effects: DataFrame


def explain_model(
    frame: DataFrame,
    model_path: str,
    key: Sequence[str],
    r2: float = 1.0,
    rows: int = SAMPLE_ROWS,
    seed: int = 0,
    store_at: str | None = None,
    run_id: str | None = None,
) -> Explanation:
    """Explain a stored model on an exact sample of ``rows`` rows; ``key`` makes a row unique.

    The sample is spread over all cores, by its rows and the model's trees, and its contributions
    are staged, as three tables read them. With ``store_at`` the tables are kept under ``run_id``.
    """
    spark = frame.sparkSession
    model = load_model(spark, model_path)
    sample = sample_n(frame, rows, list(key), seed=seed)
    contributions = cut_lineage(explain.shap_contributions(sample, model, keep=key, rows=rows))
    importance = explain.feature_importance(model.node_frame(spark), r2=r2)
    strongest = explain.top_effects(contributions, model.spec.features)
    result = Explanation(
        contributions,
        importance,
        explain.importance_by_group(importance),
        explain.shap_effects(contributions, strongest),
    )
    if store_at is not None:
        for name in ("contributions", "importance", "by_group", "effects"):
            store_result(getattr(result, name), f"{store_at}/{name}", run_id or "latest")
    return result

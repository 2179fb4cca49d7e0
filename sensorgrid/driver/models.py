"""A small fixed model for the scoring queries, so that its SQL can be written down."""

from __future__ import annotations

from sensorgrid.operators.boosting import BoostedModel, Node
from sensorgrid.operators.model import BoostParams, FeatureSpec

# (tree, node, feature, threshold, left, right, weight, rows); leaves have no feature. The first
# tree splits twice, the second once.
_SHAPE = (
    (1, 0, 0, 1, 4, 0.0, 100.0),
    (1, 1, 1, 2, 3, 0.0, 60.0),
    (1, 2, None, None, None, 12.5, 40.0),
    (1, 3, None, None, None, -30.25, 20.0),
    (1, 4, None, None, None, 4.0, 40.0),
    (2, 0, 2, 1, 2, 0.0, 100.0),
    (2, 1, None, None, None, -3.5, 50.0),
    (2, 2, None, None, None, 8.0, 50.0),
)
BASE_SCORE = 10.0


def fixed_model(*splits: tuple[str, float]) -> BoostedModel:
    """The model with its three splits on the given (feature, threshold) pairs."""
    nodes = []
    for tree, node, split, left, right, weight, rows in _SHAPE:
        feature, threshold = (None, None) if split is None else splits[split]
        gain = None if split is None else 1.0
        nodes.append(Node(tree, node, feature, threshold, left, right, weight, rows, gain))
    features = tuple(f for f, _ in splits)
    return BoostedModel(FeatureSpec("target", features), BoostParams(2, 2), BASE_SCORE, nodes, 2)

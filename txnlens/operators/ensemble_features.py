"""Ensemble feature table: align the three model scores by key (inner
equi-join) and min-max normalise them (isolation scores negated first)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENSEMBLE_FEATURES
from ..session import materialize
from .scaling import apply_minmax, fit_minmax


SCORES = ["graph_score", "reconstruction_score", "iso_score"]


def align_scores(graph: DataFrame, recon: DataFrame, iso: DataFrame, key: str = "id") -> DataFrame:
    """graph(key, graph_score[, Class]) ⋈ recon(key, reconstruction_score,
    reconstruction_pred) ⋈ iso(key, iso_score, iso_pred). Rows missing from
    any side are dropped (inner join)."""
    return graph.join(recon, key, "inner").join(iso, key, "inner")


def fit_score_range(scores: DataFrame) -> DataFrame:
    """Min-max parameters of the three scores (one row), saved for serving."""
    return fit_minmax(scores, SCORES)


def apply_score_range(scores: DataFrame, params: DataFrame) -> DataFrame:
    """All columns of ``scores`` with the six ensemble features: isolation
    scores are negated first. Training and serving share this function."""
    n = apply_minmax(scores, params, SCORES, "_norm", negate={"iso_score"})
    return n.withColumnsRenamed({"graph_score_norm": "graph_norm", "reconstruction_score_norm": "reconstruction_norm", "iso_score_norm": "iso_norm"}) \
            .withColumns({c: F.col(c).cast("double") for c in ("graph_score", "reconstruction_pred", "iso_pred")})


def ensemble_features(scores: DataFrame, key: str = "id", label: str | None = "Class") -> DataFrame:
    """(key[, label], graph_norm, reconstruction_norm, iso_norm, graph_score,
    reconstruction_pred, iso_pred). The aligned scores are written once, for
    their range and for the result."""
    s = materialize(scores, "aligned-scores")
    return apply_score_range(s, fit_score_range(s)).select(key, *([label] if label else []), *ENSEMBLE_FEATURES)

"""Clustering of persons by recency, frequency and monetary value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.kmeans import LABEL, Clustering, elbow, fit, fit_many, silhouettes, weighted_points
from cartwise.operators.knn import knn_impute
from cartwise.operators.scaling import standard_scale
from cartwise.operators.segments import median_by_group
from cartwise.session import materialise

PERSON = "customer_unique_id"
FEATURES = ["recency", "frequency", "monetary_value"]
SCALED = [f"{c}_scaled" for c in FEATURES]


@dataclass
class Prepared:
    """The written feature table: person, raw features (nulls kept), scaled features without nulls."""

    table: DataFrame

    @property
    def points(self) -> DataFrame:
        return weighted_points(self.table, SCALED)


def prepare(rfm: DataFrame, neighbours: int = 2) -> Prepared:
    """Impute and scale; the raw columns stay beside the scaled ones.

    Each step reads its input more than once, so each result is written.
    """
    raw = materialise(rfm.select(PERSON, *[F.col(c).cast("double").alias(c) for c in FEATURES]), "rfm")
    # The imputed columns stand next to the raw ones, so no join by person is needed later.
    twice = raw.select(PERSON, *FEATURES, *[F.col(c).alias(s) for c, s in zip(FEATURES, SCALED)])
    imputed = materialise(knn_impute(twice, PERSON, SCALED, neighbours), "rfm-imputed")
    return Prepared(materialise(standard_scale(imputed, SCALED), "rfm-scaled"))


def sweep(prepared: Prepared, ks: range = range(2, 10), squared: bool = False) -> DataFrame:
    """(k, inertia, silhouette) for k = 1 and every k in ``ks``; no silhouette at k = 1."""
    points = materialise(prepared.points, "rfm-points")
    models = fit_many(points, SCALED, list(ks))
    scores = silhouettes(points, SCALED, models, squared)
    rows = [(k, inertia, scores.get(k)) for k, inertia in elbow(points, SCALED, models)]
    return prepared.table.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def segment(prepared: Prepared, k: int = 4) -> tuple[Clustering, DataFrame]:
    """The fitted model and every person with raw features and cluster number."""
    model = fit(materialise(prepared.points, "rfm-points"), SCALED, k)
    return model, model.label(prepared.table).select(PERSON, *FEATURES, LABEL)


def cluster_profile(labelled: DataFrame) -> DataFrame:
    """Median of the raw features per cluster."""
    return median_by_group(materialise(labelled, "rfm-clusters"), LABEL, FEATURES)

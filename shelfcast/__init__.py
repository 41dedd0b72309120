"""Retail demand features and forecasts as plain Spark DataFrame and Spark ML jobs."""

from shelfcast.config import FeatureConfig, ForestConfig
from shelfcast.plans.features import build_features, build_features_from_long
from shelfcast.plans.stages import predict, prepare, profile_scan, run, train

__all__ = [
    "FeatureConfig",
    "ForestConfig",
    "build_features",
    "build_features_from_long",
    "predict",
    "prepare",
    "profile_scan",
    "run",
    "train",
]

"""Fitted models on disk: written and read by Spark, so any folder that the cluster shares will do."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> str:
    """Write a fitted pipeline; a folder that exists is an error, so that no model is lost unawares."""
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

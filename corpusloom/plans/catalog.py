"""All queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, corpus, sources, training

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**training.QUERIES, **corpus.QUERIES, **conversations.QUERIES, **sources.QUERIES}
ORACLES: dict[str, str] = {**training.ORACLES, **corpus.ORACLES, **conversations.ORACLES, **sources.ORACLES, "mixture_scalar_check": corpus.ORACLES["mixture_check"]}

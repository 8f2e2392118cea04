"""The feed's tables, built once per session and folder by the real jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changefeed.operators import resolve
from changefeed.operators.rules import load_rules
from changefeed.plans.materialize import resolve_epoch
from changefeed.session import shared_dir, stage
from changefeed.sources.feed import change_log
from changefeed.streaming.tables import Tables, path_exists

_BUILT: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, what: str, build: Callable[[str], object]) -> str:
    """The folder that ``build`` filled, at its first call in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _BUILT or not path_exists(spark, _BUILT[key]):
        path = f"{shared_dir(spark)}/changefeed/{what}-{uuid.uuid4().hex}"
        build(path)
        _BUILT[key] = path
    return _BUILT[key]


def examined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoded feed, staged: several queries read it more than once."""

    def build(path: str) -> None:
        stage(resolve.examine(change_log(spark, sf_dir), load_rules()), "examined", path=path)

    return spark.read.parquet(once(spark, sf_dir, "examined", build))


def sink(spark: SparkSession, sf_dir: str) -> Tables:
    """The feed resolved into tables, from the decoded feed that other queries read, too."""

    def build(path: str) -> None:
        decoded = examined(spark, sf_dir)
        resolve_epoch(change_log(spark, sf_dir), Tables(spark, path), load_rules(), 0, examined=decoded)

    return Tables(spark, once(spark, sf_dir, "sink", build))

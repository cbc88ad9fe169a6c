"""Registry of witness queries: key -> (Spark builder, DuckDB oracle SQL).

A witness runs one operator over the whole driver tables (through the fixture
views) and exposes its result as scalar columns so an order-insensitive hash
can compare it with the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.plans.fixtures import VIEWS, Views, with_views

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}


def witness(key: str, sql: str | None = None):
    """Register ``fn(v: Views) -> DataFrame`` under ``key``.

    ``sql`` is DuckDB SQL over the base tables and the fixture view names; the
    views it mentions are prepended as CTEs.
    """

    def deco(fn: Callable[[Views], DataFrame]):
        if key in _QUERIES:
            raise ValueError(f"duplicate witness {key}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(spark, sf_dir))

        build.__name__ = f"witness_{key}"
        _QUERIES[key] = build
        if sql is not None:
            used = [n for n in VIEWS if _mentions(sql, n)]
            _ORACLE[key] = with_views(sql, used)
        return fn

    return deco


def _mentions(sql: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", sql) is not None


def all_queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load() -> None:
    # importing the plan modules registers their witnesses
    from strandline.plans import (  # noqa: F401
        w_catalog,
        w_cohort,
        w_importers,
        w_manifest,
        w_pedigree,
        w_quality,
        w_refdata,
        w_releases,
        w_streams,
        w_tracks,
        w_variants,
    )

"""Python stages: user code that builds a DataFrame or registers views.

Two shapes are accepted:

* a callable ``fn(spark, **args) -> DataFrame | None``;
* a module path whose ``Loader().stage_class()`` returns a class; the class is
  instantiated with the stage arguments and the runner calls
  ``instance.run(context, spark, stage, metric)``.

User code should express its work with DataFrames; returning a DataFrame lets
the stage's output kind (view, store, cached view) apply to it.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class StageContext:
    """What a Python stage may need from the run."""

    params: Mapping[str, Any] = field(default_factory=dict)
    compute_time: int | None = None
    store_path: str | None = None


class BaseStage:
    """Base for module stages; subclasses override :meth:`run`."""

    def __init__(self, **kwargs: Any) -> None:
        self.args = kwargs

    def run(self, context: StageContext, spark: SparkSession, stage, metric) -> DataFrame | None:
        raise NotImplementedError


class BaseLoader:
    """A stage module defines ``Loader`` with ``stage_class()``."""

    def stage_class(self) -> type[BaseStage]:
        raise NotImplementedError


def resolve_stage(target: Callable[..., Any] | str) -> Callable[..., Any] | type:
    if callable(target):
        return target
    module = importlib.import_module(target)
    loader = getattr(module, "Loader", None)
    if loader is None:
        raise ValueError(f"module {target!r} defines no Loader")
    return loader().stage_class()


def python_stage(
    spark: SparkSession,
    target: Callable[..., Any] | str,
    args: Mapping[str, Any] | None = None,
    *,
    context: StageContext | None = None,
    stage=None,
    metric=None,
) -> DataFrame | None:
    """Run one Python stage; returns its DataFrame, or ``None`` if it only made views."""
    resolved = resolve_stage(target)
    args = dict(args or {})
    if isinstance(resolved, type):
        result = resolved(**args).run(context or StageContext(), spark, stage, metric)
    else:
        result = resolved(spark, **args)
    if result is not None and not isinstance(result, DataFrame):
        raise TypeError(f"python stage returned {type(result).__name__}, not a DataFrame")
    return result

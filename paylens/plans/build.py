"""Build models in order, test each, stop at the first failure."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from paylens.operators.contracts import ModelTest, model_tests


@dataclass(frozen=True)
class Model:
    """``make`` gets the models built so far; ``kind`` is view or table."""

    name: str
    make: Callable[[dict[str, DataFrame]], DataFrame]
    kind: str = "view"
    tests: Sequence[ModelTest] = field(default_factory=tuple)


class TestFailure(RuntimeError):
    __test__ = False


def build(spark: SparkSession, models: Sequence[Model], folder: str) -> dict[str, DataFrame]:
    """Tables are written once and read back by the models after them."""
    built: dict[str, DataFrame] = {}
    for model in models:
        df = model.make(built)
        if model.kind == "table":
            df.write.mode("overwrite").parquet(f"{folder}/{model.name}")
            df = spark.read.parquet(f"{folder}/{model.name}")
        if model.tests:
            broken = model_tests(df, model.tests).where("NOT passed").collect()
            if broken:
                names = ", ".join(f"{r['test']}({r['column_name']})={r['failures']}" for r in broken)
                raise TestFailure(f"{model.name}: {names}")
        built[model.name] = df
    return built

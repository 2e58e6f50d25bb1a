"""The planner, settings and the streamed quality counts."""

import pytest
from pyspark.sql import functions as F

from varloom.plans.registry import Registry, digest, layered
from varloom.streaming import quality


def test_registry_runs_once_in_order(spark):
    r, calls = Registry(), []

    def step(name):
        def run(spark, inputs, settings):
            calls.append(name)
            base = next(iter(inputs.values()), spark.range(3))
            return base.withColumn(name, F.lit(settings.get("v", 0)))

        return run

    r.add("a", step("a"))
    r.add("b", step("b"), ["a"])
    r.add("c", step("c"), ["a", "b"])
    done = r.execute(spark, ["c", "b"], {}, {"b": {"v": 5}})
    assert calls == ["a", "b", "c"] and done["b"].first().b == 5
    with pytest.raises(ValueError):
        r.add("a", step("a"))
    r.add("d", "varloom.plans.registry:digest")
    assert r.resolve("d") is digest


def test_layers():
    assert layered({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"y": 3}}, {"b": None}) == {"a": {"x": 1, "y": 3}, "b": None}
    assert digest({"a": 1, "b": 2}) == digest({"b": 2, "a": 1})


def test_streamed_counts_pool(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate([[0.5, 1.2, None], [2.5, -1.0]]):
        spark.createDataFrame([(x,) for x in rows], "info double").coalesce(1).write.mode("append").parquet(src)
    q = quality.start(spark, src, spark.read.parquet(src).schema, "info", out, str(tmp_path / "ck"))
    q.awaitTermination()
    r = quality.pooled(spark, out).first()
    assert (r.rows, r.finite, r.unit, r.to_2, r.above_2, r.below_0) == (5, 4, 1, 1, 1, 1) and r.least == -1.0 and r.most == 2.5

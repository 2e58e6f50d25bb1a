"""Modules by name, what they need, and runs of them in order."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from importlib import import_module
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from ..operators.graph import dependency_order
from ..runtime import shared_dir


class Method(Protocol):
    """A plug-in: preflight raises on bad settings, run returns a table."""

    def preflight(self, settings: dict) -> None: ...

    def run(self, spark: SparkSession, inputs: dict[str, DataFrame], settings: dict) -> DataFrame: ...


@dataclass
class Registry:
    """Modules as (function or import string, needs)."""

    modules: dict[str, tuple[Callable | str, tuple[str, ...]]] = field(default_factory=dict)

    def add(self, name: str, run: Callable | str, needs: Iterable[str] = ()) -> None:
        if name in self.modules:
            raise ValueError(f"{name} is there already")
        self.modules[name] = (run, tuple(needs))

    def resolve(self, name: str) -> Callable:
        run = self.modules[name][0]
        if isinstance(run, str):
            module, _, attribute = run.partition(":")
            run = getattr(import_module(module), attribute)
        return run

    def order(self, targets: Iterable[str]) -> list[str]:
        return dependency_order(targets, {k: v[1] for k, v in self.modules.items()})

    def execute(self, spark: SparkSession, targets: Iterable[str], inputs: dict[str, DataFrame], settings: dict | None = None) -> dict[str, DataFrame]:
        """Run targets and what they need; each result is written once and read by those that need it."""
        done = dict(inputs)
        for name in self.order(targets):
            if name in done:
                continue
            out = self.resolve(name)(spark, {k: done[k] for k in self.modules[name][1]}, (settings or {}).get(name, {}))
            path = shared_dir(spark, f"{name}-{digest((settings or {}).get(name, {}))}")
            out.write.parquet(path)
            done[name] = spark.read.schema(out.schema).parquet(path)
        return done


def layered(*sources: dict) -> dict:
    """Settings by precedence, later ones over earlier, section by section."""
    out: dict = {}
    for s in sources:
        for k, v in s.items():
            out[k] = layered(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def digest(settings: dict) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:12]

"""Named steps: each takes a DataFrame and settings and returns a DataFrame."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

Step = Callable[..., DataFrame]


class Registry:
    def __init__(self) -> None:
        self._steps: dict[str, Step] = {}

    def register(self, name: str) -> Callable[[Step], Step]:
        def keep(step: Step) -> Step:
            if name in self._steps:
                raise ValueError(f"{name} is registered already")
            self._steps[name] = step
            return step

        return keep

    def discover(self, package: str) -> list[str]:
        """Import every module of a package, which may register steps; a package that isn't there is a ``ValueError``."""
        try:
            found = importlib.import_module(package)
        except ModuleNotFoundError as e:
            raise ValueError(f"no package {package}") from e
        for m in pkgutil.iter_modules(found.__path__):
            importlib.import_module(f"{package}.{m.name}")
        return self.names()

    def get(self, name: str) -> Step | None:
        return self._steps.get(name)

    def names(self) -> list[str]:
        return sorted(self._steps)

    def run(self, df: DataFrame, name: str, **settings: Any) -> DataFrame:
        step = self.get(name)
        if step is None:
            raise KeyError(f"no step {name}")
        return df.transform(lambda x: step(x, **settings))


mappers, validators, preprocessors, exporters = Registry(), Registry(), Registry(), Registry()

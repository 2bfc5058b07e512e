"""Base classes of the fitted transformers: parameters, state, persistence."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import DataFrame


def names(name: str, doc: str = "") -> Param:
    return Param(Params._dummy(), name, doc or name, TypeConverters.toListString)


def text(name: str, doc: str = "") -> Param:
    return Param(Params._dummy(), name, doc or name, TypeConverters.toString)


def number(name: str, doc: str = "") -> Param:
    return Param(Params._dummy(), name, doc or name, TypeConverters.toFloat)


def integer(name: str, doc: str = "") -> Param:
    return Param(Params._dummy(), name, doc or name, TypeConverters.toInt)


def flag(name: str, doc: str = "") -> Param:
    return Param(Params._dummy(), name, doc or name, TypeConverters.toBoolean)


class Settings(Params):
    """Keyword construction and short access to parameter values."""

    inputCols = names("inputCols", "columns the step reads")
    defaults: dict = {}

    def __init__(self, **params):
        super().__init__()
        self._setDefault(**self.defaults)
        self._set(**{k: v for k, v in params.items() if v is not None})

    def value(self, name: str):
        return self.getOrDefault(name) if self.isDefined(name) else None


class _StateWriter(MLWriter):
    def __init__(self, instance: "FittedStep"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        step = self.instance
        DefaultParamsWriter.saveMetadata(
            step, path, self.sparkSession, extraMetadata={"state": step.state, "tables": sorted(step.tables), "models": sorted(step.models)})
        for name, table in step.tables.items():
            table.write.parquet(f"{path}/tables/{name}")
        for name, model in step.models.items():
            model.write().save(f"{path}/models/{name}")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        step = self.cls()
        step._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(step, metadata)
        step.state = metadata["state"]
        step.tables = {n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for n in metadata["tables"]}
        step.models = {
            n: DefaultParamsReader.loadParamsInstance(f"{path}/models/{n}", self.sparkSession) for n in metadata["models"]}
        return step


class FittedStep(Settings, Model, MLWritable, MLReadable):
    """A model whose knowledge is a JSON-able ``state`` plus lookup ``tables``.

    ``state`` holds numbers per column or per class, small by construction.
    Anything that grows with the number of categories is a table. Composite
    steps keep their parts in ``models``.
    """

    def __init__(self, **params):
        super().__init__(**params)
        self.state: dict = {}
        self.tables: dict[str, DataFrame] = {}
        self.models: dict[str, Model] = {}

    @property
    def members(self) -> list[Model]:
        return [self.models[f"m{i}"] for i in range(len(self.models)) if f"m{i}" in self.models]

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)


class FitStep(Settings, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator that learns a ``FittedStep`` of type ``model``."""

    model: type[FittedStep]

    def fitted(self, state: dict | None = None, **tables: DataFrame) -> FittedStep:
        step = self._copyValues(self.model())
        step.state = state or {}
        step.tables = tables
        return step

    @staticmethod
    def numbered(models: list[Model]) -> dict[str, Model]:
        return {f"m{i}": m for i, m in enumerate(models)}


class _PartsWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        plain, parts = self.instance.to_parts()
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"plain": plain, "parts": sorted(parts)})
        for name, part in parts.items():
            part.write().save(f"{path}/parts/{name}")


class _PartsReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = {n: DefaultParamsReader.loadParamsInstance(f"{path}/parts/{n}", self.sparkSession) for n in metadata["parts"]}
        step = self.cls.from_parts(metadata["plain"], parts)
        step._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(step, metadata)
        return step


class MadeOfSteps:
    """Saving and loading of an unfitted estimator that holds others.

    ``to_parts`` gives JSON-able settings and the parts by name; ``from_parts`` builds the estimator again.
    """

    def to_parts(self) -> tuple[dict, dict]:
        raise NotImplementedError

    @classmethod
    def from_parts(cls, plain: dict, parts: dict):
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _PartsWriter(self)

    @classmethod
    def read(cls):
        return _PartsReader(cls)


class PlainStep(Settings, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer without anything to learn."""

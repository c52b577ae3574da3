"""What users can add: named operations and their own table readers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass(frozen=True)
class Operation:
    """A function with declared parameters and a declared result."""

    name: str
    params: Mapping[str, bool]
    schema: T.StructType | str | None
    kind: str
    run: Callable[..., DataFrame]


_OPERATIONS: dict[str, Operation] = {}


def operation(name: str, params: Mapping[str, bool], schema: T.StructType | str | None = None, kind: str = "data"):
    """Register a function ``(spark, **params) -> DataFrame``; ``params`` says which ones are required."""
    if kind not in ("metadata", "data"):
        raise ValueError("kind is metadata or data")

    def keep(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _OPERATIONS[name] = Operation(name, dict(params), schema, kind, fn)
        return fn

    return keep


def run_operation(spark: SparkSession, name: str, **params: object) -> DataFrame:
    """Run an operation; unknown names, missing and unknown parameters and a wrong result schema are errors."""
    if name not in _OPERATIONS:
        raise ValueError(f"unknown operation {name}; available: {', '.join(sorted(_OPERATIONS))}")
    op = _OPERATIONS[name]
    missing = [p for p, required in op.params.items() if required and params.get(p) in (None, "")]
    unknown = sorted(set(params) - set(op.params))
    if missing or unknown:
        raise ValueError(f"{name}: missing {missing}, unknown {unknown}")
    result = op.run(spark, **params)
    declared = T.StructType.fromDDL(op.schema) if isinstance(op.schema, str) else op.schema
    if declared is not None and result.schema.simpleString() != declared.simpleString():
        raise TypeError(f"{name} returned {result.schema.simpleString()}, declared {declared.simpleString()}")
    return result


def register_reader(
    spark: SparkSession,
    name: str,
    schema: T.StructType | str,
    plan: Callable[[Mapping[str, str]], Sequence[object]],
    read: Callable[[Mapping[str, str], object], Iterator[tuple]],
) -> None:
    """Make ``spark.read.format(name)`` read with the user's functions.

    ``plan`` turns the options into descriptors of independent pieces on the driver; ``read`` yields the rows of one
    piece, as tuples or Arrow batches, on an executor.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: Mapping[str, str]) -> None:
            self.options = dict(options)

        def partitions(self) -> list[InputPartition]:
            return [InputPartition(piece) for piece in plan(self.options)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            return read(self.options, partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType | str:
            return schema

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader(self.options)

    spark.dataSource.register(Source)

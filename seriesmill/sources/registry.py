"""Registering own sources and stores beside the built-in ones.

A source is a reader function with the schema it promises, a store is six
functions.  What is checked is the schema of a source's rows, and that a store has
all its functions with the arguments they are called with.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesmill.schemas import (
    DERIVATIVES,
    MACRO,
    OHLCV,
    SENTIMENT,
    check_schema,
    keyed,
    schema_violations,
)
from seriesmill.sources import files, landed, manifest


@dataclass(frozen=True)
class Source:
    name: str
    schema: T.StructType
    read: Callable[..., DataFrame]


@dataclass(frozen=True)
class Store:
    """A place for datasets.

    ``write(df, path)`` and ``read(spark, path, schema)`` move rows; ``delete(spark, path)``
    and ``exists(spark, path)`` tell whether the dataset was there; ``list(spark, path)``
    has a row with an ``id`` for every dataset below a folder; ``time_range(spark, path,
    schema)`` has one row with ``start_time`` and ``end_time``.
    """

    name: str
    write: Callable[..., object]
    read: Callable[..., DataFrame]
    delete: Callable[..., bool]
    exists: Callable[..., bool]
    list: Callable[..., DataFrame]
    time_range: Callable[..., DataFrame]


#: The arguments that each function of a store is called with.
STORE_CALLS = {
    "write": ("df", "path"),
    "read": ("spark", "path", "schema"),
    "delete": ("spark", "path"),
    "exists": ("spark", "path"),
    "list": ("spark", "path"),
    "time_range": ("spark", "path", "schema"),
}


_sources: dict[str, Source] = {}
_stores: dict[str, Store] = {}


def register_source(source: Source, *, replace: bool = False) -> None:
    """Add a source; its schema must have a time column besides the series keys."""
    if source.name in _sources and not replace:
        raise ValueError(f"source {source.name!r} is already registered")
    problems = _source_problems(source)
    if problems:
        raise ValueError(f"source {source.name!r}:\n" + "\n".join(f"- {p}" for p in problems))
    _sources[source.name] = source


def _source_problems(source: Source) -> list[str]:
    problems = []
    if not source.name:
        problems.append("a name is required")
    if not callable(source.read):
        problems.append("read must be callable")
    fields = {f.name: f.dataType for f in source.schema.fields}
    for name, kind in [
        ("symbol", T.StringType()), ("timeframe", T.StringType()), ("time", T.TimestampType())
    ]:
        if fields.get(name) != kind:
            problems.append(f"schema needs '{name}' {kind.simpleString()}")
    if not set(fields) - {"source", "symbol", "timeframe", "time"}:
        problems.append("schema needs at least one value column")
    return problems


def register_store(store: Store, *, replace: bool = False) -> None:
    if store.name in _stores and not replace:
        raise ValueError(f"store {store.name!r} is already registered")
    problems = store_problems(store)
    if problems:
        raise ValueError(f"store {store.name!r}:\n" + "\n".join(f"- {p}" for p in problems))
    _stores[store.name] = store


def store_problems(store: Store) -> list[str]:
    """Everything that keeps a store from being used; empty when it fits."""
    problems = [] if store.name else ["a name is required"]
    for name, arguments in STORE_CALLS.items():
        function = getattr(store, name)
        if not callable(function):
            problems.append(f"{name} must be callable")
            continue
        try:
            inspect.signature(function).bind(*arguments)
        except TypeError as error:
            problems.append(f"{name}({', '.join(arguments)}): {error}")
        except ValueError:
            pass  # a built-in without a signature
    return problems


def source_names() -> list[str]:
    return sorted(_sources)


def store_names() -> list[str]:
    return sorted(_stores)


def get_store(name: str) -> Store:
    if name not in _stores:
        raise ValueError(f"store {name!r} is not one of {store_names()}")
    return _stores[name]


def read_source(spark: SparkSession, name: str, path: str, **options) -> DataFrame:
    """Rows of a registered source, checked against its schema."""
    if name not in _sources:
        raise ValueError(f"source {name!r} is not one of {source_names()}")
    source = _sources[name]
    return check_schema(source.read(spark, path, **options), source.schema, f"source {name!r}")


def verify_rows(name: str, df: DataFrame) -> tuple[bool, list[str]]:
    """Whether rows fit a source, and everything that does not."""
    problems = schema_violations(df, _sources[name].schema)
    return not problems, problems


for _source in (
    Source("spot", keyed(OHLCV), landed.read_spot),
    Source("market", keyed(OHLCV), landed.read_market),
    Source("derivatives", keyed(DERIVATIVES), landed.read_derivatives),
    Source("macro", keyed(MACRO), landed.read_macro),
    Source("sentiment", keyed(SENTIMENT), landed.read_sentiment),
):
    register_source(_source)


def _file_store(fmt: str) -> Store:
    return Store(
        fmt,
        lambda df, path: files.save_files(df, path, fmt),
        lambda spark, path, schema: files.load_files(spark, path, schema, fmt),
        files.delete_files,
        files.files_exist,
        lambda spark, path: files.list_files(spark, path, fmt),
        lambda spark, path, schema: files.files_time_range(spark, path, schema, fmt),
    )


for _fmt in files.EXTENSIONS:
    register_store(_file_store(_fmt))
register_store(
    Store(
        "manifest",
        manifest.save,
        manifest.load,
        manifest.delete,
        manifest.exists,
        manifest.datasets,
        lambda spark, path, schema: manifest.time_range(spark, path),
    )
)

"""Warehouse models: registry, build context and materialisation.

A model is a plain function ``fn(ctx) -> DataFrame``.  It reads staging
tables with ``ctx.source(name)`` and other models with ``ctx.ref(name)``;
dependencies are discovered from these calls, so the build order needs no
separate declaration.  Within one context every model is built once and
shared, so Catalyst sees one plan per model (and ``ReuseExchange`` removes
repeated shuffles of a shared subplan).  ``materialize`` writes models to
Parquet and re-reads them, which is how the warehouse stores its ``table``
models and what cuts the lineage between layers on a cluster.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ModelSpec:
    name: str
    layer: str           # silver | gold | intermediate
    fn: Callable[["ModelContext"], DataFrame]
    doc: str


MODELS: dict[str, ModelSpec] = {}


def model(name: str, layer: str):
    """Register ``fn(ctx) -> DataFrame`` as the warehouse model ``name``."""
    def deco(fn):
        if name in MODELS:
            raise ValueError(f"duplicate model {name}")
        MODELS[name] = ModelSpec(name, layer, fn, (fn.__doc__ or "").strip())
        return fn
    return deco


class MissingInput(KeyError):
    pass


@dataclass
class ModelContext:
    """Inputs of one build: staging tables, optional prebuilt models (for
    example stored silver tables, or models this library does not build),
    template variables and the ``as_of`` date that replaces ``current_date``."""

    spark: SparkSession
    sources: Mapping[str, DataFrame]
    as_of: dt.date
    vars: Mapping[str, object] = field(default_factory=dict)
    provided: Mapping[str, DataFrame] = field(default_factory=dict)
    _built: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _stack: list[str] = field(default_factory=list, repr=False)
    _deps: dict[str, set[str]] = field(default_factory=dict, repr=False)

    def source(self, name: str) -> DataFrame:
        try:
            return self.sources[name]
        except KeyError:
            raise MissingInput(f"staging table {name!r} not given") from None

    def var(self, name: str, default: object = None) -> object:
        v = self.vars.get(name, default)
        if v is None:
            raise MissingInput(f"variable {name!r} not set")
        return v

    def ref(self, name: str) -> DataFrame:
        if self._stack:
            self._deps.setdefault(self._stack[-1], set()).add(name)
        if name in self.provided:
            return self.provided[name]
        if name in self._built:
            return self._built[name]
        if name not in MODELS:
            raise MissingInput(f"model {name!r} is neither registered nor provided")
        if name in self._stack:
            raise RuntimeError("model cycle: " + " -> ".join([*self._stack, name]))
        self._stack.append(name)
        try:
            df = MODELS[name].fn(self)
        finally:
            self._stack.pop()
        self._built[name] = df
        return df

    def set_built(self, name: str, df: DataFrame) -> None:
        self._built[name] = df


def build(ctx: ModelContext, names: Iterable[str]) -> dict[str, DataFrame]:
    """Lazy DataFrames for ``names`` (and, through ``ref``, their inputs)."""
    return {n: ctx.ref(n) for n in names}


def materialize(ctx: ModelContext, names: Iterable[str], root: str,
                mode: str = "overwrite") -> dict[str, str]:
    """Build ``names`` in dependency order, writing each model to
    ``root/<layer>/<name>`` as Parquet and re-reading it, so downstream
    models start from stored files (lineage cut, no recomputation after an
    executor loss).  Returns the written paths."""
    names = list(names)
    for n in names:            # discover the dependency graph
        ctx.ref(n)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n in ctx.provided:
            return
        for d in sorted(ctx._deps.get(n, ())):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    paths: dict[str, str] = {}
    for n in order:            # inputs first; rebuild each model on stored inputs
        ctx._built.pop(n, None)
        path = f"{root.rstrip('/')}/{MODELS[n].layer}/{n}"
        ctx.ref(n).write.mode(mode).parquet(path)
        ctx.set_built(n, ctx.spark.read.parquet(path))
        paths[n] = path
    return paths


def checkpoint_models(ctx: ModelContext, names: Iterable[str]) -> None:
    """Replace models that several downstream models read by reliable
    checkpoints in the session's shared ``spark.checkpoint.dir`` (eager: each
    is computed once, later plans start from its files, and a lost executor
    never forces the upstream chain to be recomputed).  ``materialize`` is
    the persistent variant that writes named warehouse tables."""
    from lakeward.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(ctx.spark)
    for n in names:
        ctx.set_built(n, ctx.ref(n).checkpoint(eager=True))

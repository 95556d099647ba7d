"""Catalogue of the decision queries: what they are, on which models, with which parameters."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from caseloom.plans import bucket_queries, graph_queries, star_queries
from caseloom.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Parameter:
    name: str
    kind: type
    default: Any


@dataclass(frozen=True)
class Query:
    title: str
    operation: str
    models: tuple[str, ...]
    parameters: tuple[Parameter, ...] = ()


_ALL, _GRAPH = ("star", "bucket", "graph"), ("graph",)
_DISEASE = Parameter("disease", str, "MEASLES")

CATALOG: dict[str, Query] = {
    "Q1": Query("Cases by disease and decade", "Roll-up", _ALL),
    "Q2": Query("Incidence by state for one year", "Slice", _ALL, (Parameter("year", int, 1960),)),
    "Q3": Query("Top states for a disease and range of years", "Dice", _ALL, (
        _DISEASE, Parameter("start_year", int, 1950), Parameter("end_year", int, 1970))),
    "Q4": Query("Seasonal mean of weekly cases per month", "Roll-up", _ALL, (_DISEASE,)),
    "Q5": Query("Year-over-year change by state", "Pivot", _ALL, (_DISEASE,)),
    "Q6": Query("Co-occurring diseases by state and year", "Dice", _ALL),
    "Q7": Query("States ranked by first report", "Drill-down", _ALL, (_DISEASE,)),
    "Q8": Query("Mean yearly cases before and after the vaccine", "Slice", _ALL),
    "Q9": Query("State-years far above the national mean", "Statistical", _ALL),
    "Q10": Query("Yearly cases relative to the peak year", "Pivot", _ALL),
    "Q11": Query("Spread across state borders", "Graph Traversal", _GRAPH, (
        _DISEASE, Parameter("threshold", int, 50))),
    "Q12": Query("Disease profile of each state", "Graph Pattern", _GRAPH),
    "Q13": Query("Presence and coverage of each disease", "Graph Centrality", _GRAPH),
}

_MODULES = {"star": star_queries, "bucket": bucket_queries, "graph": graph_queries}


def query_function(query_id: str, model: str) -> Callable[..., DataFrame]:
    entry = CATALOG.get(query_id)
    if entry is None:
        raise KeyError(f"unknown query {query_id!r}; known: {list(CATALOG)}")
    if model not in entry.models:
        raise KeyError(f"{query_id} is not defined on {model!r}; models: {list(entry.models)}")
    return getattr(_MODULES[model], f"q{int(query_id[1:]):02d}_{model}")


def run(warehouse: Warehouse, query_id: str, model: str, **parameters: Any) -> DataFrame:
    """The answer of one query on one model; parameters not given take their defaults."""
    function = query_function(query_id, model)
    handle = {"star": warehouse.star, "bucket": warehouse.buckets, "graph": warehouse.graph}[model]()
    values = {p.name: p.kind(parameters.get(p.name, p.default)) for p in CATALOG[query_id].parameters}
    extra = {name: value for name, value in parameters.items() if name not in values}
    return function(handle, **values, **extra)


def run_all_models(warehouse: Warehouse, query_id: str, **parameters: Any) -> dict[str, DataFrame]:
    """The same query on every model it is defined on."""
    return {m: run(warehouse, query_id, m, **parameters) for m in CATALOG[query_id].models}


def timed(build: Callable[[], DataFrame], runs: int = 7, warm_ups: int = 2) -> dict[str, Any]:
    """Times full executions into a sink that keeps nothing; warm-ups are dropped."""
    samples = []
    for _ in range(runs):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        samples.append(time.perf_counter() - started)
    kept = sorted(samples[warm_ups:] or samples)
    last = len(kept) - 1
    return {"median": statistics.median(kept), "p25": kept[int(0.25 * last)],
            "p75": kept[min(last, int(0.75 * last))], "runs": samples}

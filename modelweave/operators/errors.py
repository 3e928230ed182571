"""Rows and errors: every fallible step returns both, and nothing is raised inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modelweave.functions.scale import materialize, measured, numbered
from modelweave.schemas import ERRORS, struct

ERROR_COLUMNS = ("resource", "element", "severity", "code", "message")
MESSAGES_PER_ROW = 1000
SEVERITIES = ("warning", "error", "fatal")


@dataclass(frozen=True)
class Result:
    rows: DataFrame
    errors: DataFrame


def no_errors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], struct(ERRORS))


def error_rows(
    df: DataFrame,
    code: str,
    message: Column,
    element: Column | str = "uuid",
    resource: Column | str = "resource",
    severity: str = "error",
) -> DataFrame:
    """Turn the rows of ``df`` into error rows."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(
        as_col(resource).cast("string").alias("resource"),
        as_col(element).cast("string").alias("element"),
        F.lit(severity).alias("severity"),
        F.lit(code).alias("code"),
        message.alias("message"),
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def append(*results: Result) -> Result:
    """Good rows of all steps and errors of all steps."""
    return Result(union_all(r.rows for r in results), union_all(r.errors for r in results))


class Chain:
    """Fallible steps over documents, one after the other; a step that gives a document only errors ends it.

    Every step is given the resources still open and returns rows and errors with their ``resource``; both are
    written to the shared folder. ``gates`` has a row for every document and step it came to: its rows, its errors
    (warnings do not count) and the outcome ``done``, ``partial`` or ``stopped``. Other documents go on.
    """

    def __init__(self, resources: DataFrame):
        self.open = resources.select("resource").filter("resource is not null").distinct()
        self._gates: list[DataFrame] = []

    def step(self, name: str, run: Callable[[DataFrame], Result]) -> Result:
        found = run(self.open)
        rows, errors = materialize(found.rows, f"step-{name}"), materialize(found.errors, f"step-{name}-errors")
        bad = errors.filter("severity <> 'warning'")
        gate = self.open
        for counted, column in ((rows, "n_rows"), (bad, "n_errors")):
            gate = gate.join(counted.groupBy("resource").agg(F.count(F.lit(1)).alias(column)), "resource", "left")
        gate = gate.na.fill(0, ["n_rows", "n_errors"])
        outcome = F.when(F.col("n_errors") == 0, "done").when(F.col("n_rows") == 0, "stopped").otherwise("partial")
        gate = materialize(
            gate.select("resource", F.lit(len(self._gates)).alias("place"), F.lit(name).alias("step"), "n_rows",
                        "n_errors", outcome.alias("outcome")),
            "gates",
        )
        self._gates.append(gate)
        self.open = gate.filter("outcome <> 'stopped'").select("resource")
        return Result(rows, errors)

    def gates(self) -> DataFrame:
        return union_all(self._gates)


@dataclass(frozen=True)
class Report:
    """Errors of several steps, each once and with the first ``step`` that gave it, and their counts."""

    errors: DataFrame
    counts: dict[tuple[str, str], int]

    def by_step(self) -> DataFrame:
        """(step, severity, n) of the steps and severities that have errors: one row each, however many errors."""
        found = [(step, severity, n) for (step, severity), n in self.counts.items() if n]
        return self.errors.sparkSession.createDataFrame(found, "step string, severity string, n long")

    def stop(self, severity: str = "fatal") -> None:
        """Raise if any step has an error of this severity; the message says how many each has."""
        bad = {step: n for (step, own), n in self.counts.items() if own == severity and n}
        if bad:
            raise ValueError(f"{severity} errors: " + ", ".join(f"{step} {n}" for step, n in bad.items()))


def report(steps: Mapping[str, DataFrame]) -> Report:
    """The errors of named steps, written once; the counts by step and severity come from that same pass.

    An error that several steps give counts for the first of them. Steps without errors are in ``counts`` with 0.
    """
    names = list(steps)
    placed = union_all(e.select(*ERROR_COLUMNS, F.lit(i).alias("_at")) for i, e in enumerate(steps.values()))
    once = placed.groupBy(*ERROR_COLUMNS).agg(F.min("_at").alias("_at"))
    wanted = {(i, severity): f"n{i}_{severity}" for i in range(len(names)) for severity in SEVERITIES}
    metrics = {
        name: F.count_if((F.col("_at") == i) & (F.col("severity") == severity))
        for (i, severity), name in wanted.items()
    }
    kept, seen = measured(once, "report", metrics)
    step = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_at") + 1)
    return Report(
        kept.select(*ERROR_COLUMNS, step.alias("step")),
        {(names[i], severity): int(seen[name]) for (i, severity), name in wanted.items()},
    )


def distinct_errors(errors: DataFrame) -> DataFrame:
    """An error that reached the report over two paths is one error."""
    return errors.select(*ERROR_COLUMNS).distinct()


def errors_by_element(
    errors: DataFrame, root: str, messages_per_row: int = MESSAGES_PER_ROW, hot_rows: int | None = None
) -> DataFrame:
    """Messages of each element joined by newlines; those without an element go under ``root``.

    An element with more than ``messages_per_row`` messages gets several rows, numbered by
    ``block``, so that no text is unbounded and no message is lost. ``n_of_element`` counts the messages
    of the element, ``n_of_all`` those of the report.
    """
    keyed, seen = measured(
        distinct_errors(errors).select(
            F.coalesce("element", F.lit(root)).alias("element"), "code", "message", "resource", "severity"
        ),
        "errors",
        {"n": F.count(F.lit(1))},
    )
    order = [F.col(c).asc_nulls_first() for c in ("code", "message", "resource", "severity")]
    total = int(seen["n"])
    placed = numbered(keyed, ["element"], order, out="_place", hot_rows=hot_rows, rows=total)
    block = F.floor(F.col("_place") / messages_per_row).cast("int")
    said = F.transform(
        F.array_sort(F.collect_list(F.struct("_place", "message"))), lambda m: F.coalesce(m["message"], F.lit("null"))
    )
    return (
        placed.withColumn("block", block)
        .groupBy("element", "block")
        .agg(F.array_join(said, "\n").alias("messages"), F.count(F.lit(1)).alias("n_messages"))
        .withColumn("n_of_element", F.sum("n_messages").over(Window.partitionBy("element")))
        .withColumn("n_of_all", F.lit(total).cast("long"))
    )


def error_totals(errors: DataFrame) -> DataFrame:
    return distinct_errors(errors).groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))

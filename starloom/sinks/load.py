"""Load jobs: ordered phases of steps, one report row per step."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

REPORT_SCHEMA = "phase int, step string, status string, n_rows bigint, error string"

Step = Callable[[], int | None]


class LoadError(Exception):
    """A step failed; ``report`` holds the outcome of every step."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def _attempt(phase: int, name: str, step: Step) -> tuple:
    try:
        return (phase, name, "ok", step(), None)
    except Exception as error:  # any failure belongs in the report
        return (phase, name, "failed", None, str(error))


def run_load(spark: SparkSession, phases: Sequence[Mapping[str, Step]]) -> DataFrame:
    """Run the phases in order and return the report.

    The steps of a phase are independent and are submitted to Spark together. All of them are tried
    even if one fails; the phases after a failed one are skipped, and the job then raises.
    """
    rows: list[tuple] = []
    failed = False
    for number, steps in enumerate(phases, start=1):
        if failed:
            rows += [(number, name, "skipped", None, None) for name in steps]
            continue
        with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
            outcomes = list(pool.map(lambda s, n=number: _attempt(n, *s), steps.items()))
        rows += outcomes
        failed = any(outcome[2] == "failed" for outcome in outcomes)
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    if failed:
        errors = "; ".join(f"{r[1]}: {r[4]}" for r in rows if r[2] == "failed")
        raise LoadError(errors, report)
    return report

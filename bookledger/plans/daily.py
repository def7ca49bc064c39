"""The daily job: wait-free check that the data is there, build, write, verify."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from bookledger.plans.checks import is_ready
from bookledger.plans.pipeline import BookingsPipeline
from bookledger.sources.inputs import BookingsInputs
from bookledger.sources.sinks import Storage, write_bookings


class NotReadyError(RuntimeError):
    """The source has no data of the day yet; the caller decides when to try again."""


def build_daily(inputs: BookingsInputs, as_of: datetime, path: str, folder: str) -> DataFrame:
    """Replace the bookings at ``path`` and return the quality checks with their failures.

    ``as_of`` is the end of the run's interval; a time without a zone is UTC. Intermediate tables go below
    ``folder``, which all executors share, and are removed at the end. The checks read the
    written bookings.
    """
    if not is_ready(inputs["freshness_source"], as_of, inputs.config):
        raise NotReadyError(f"no data for the local date of {as_of} UTC")
    spark = inputs.spark
    storage = Storage(spark, folder)
    try:
        pipeline = BookingsPipeline(inputs, storage).prepare("bookings_quality")
        written = write_bookings(pipeline.line_item_bookings, path)
        checked = pipeline.quality_of(spark.read.parquet(written))
        # A row for each check.
        return spark.createDataFrame(checked.collect(), checked.schema)
    finally:
        storage.remove()

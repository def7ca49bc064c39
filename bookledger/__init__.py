"""Booking-event ledger on Spark DataFrames.

``plans.pipeline.BookingsPipeline`` wires the business stages, ``operators`` holds the
reusable DataFrame operators, ``sources`` reads inputs and writes results.
"""

from bookledger.config import BookingsConfig

__all__ = ["BookingsConfig"]

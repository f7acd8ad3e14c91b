"""Structured Streaming entry points.

The modelled project is batch: live feeds are re-pulled on a schedule and
each pull replaces the raw table.  ``refresh`` expresses that schedule as a
file-source stream with an ``availableNow`` trigger, so each run picks up
exactly the drops that arrived since the last one (tracked in a checkpoint
under ``spark.checkpoint.dir``) and survives restarts.
"""

from parcelflow.streaming.refresh import refresh_feed  # noqa: F401

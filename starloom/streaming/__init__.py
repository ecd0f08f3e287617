"""Arrival-driven runs over an extract folder (Structured Streaming).

The original schedules two jobs: a source profile every two minutes and a
full star refresh every hour.  Here both are file-source streams with a
checkpoint, run with ``trigger(availableNow=True)`` by whatever scheduler the
user has (or continuously with a processing-time trigger):

* ``profile_arrivals`` - rows and columns of every newly arrived extract
  file, appended to a profile table exactly once per file;
* ``refresh_on_arrival`` - a full rebuild of the star whenever new order
  extracts have arrived (the hourly refresh, only when there is new data).

Offsets live in the stream checkpoint, so a restarted or retried run neither
skips nor repeats a file; each batch writes into its own ``batch_id=``
folder with overwrite, so a replayed batch replaces its own output.
"""

from starloom.streaming.arrivals import profile_arrivals, refresh_on_arrival

__all__ = ["profile_arrivals", "refresh_on_arrival"]

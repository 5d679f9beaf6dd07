"""Fetch results that arrive as a stream: which run's records each source goes on with, kept as state per source."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RESULT = "source_id string, run long, ok boolean, taken long, used_cache boolean"
#: The run that is open, its last fetch's place and outcome, whether any of its fetches was good, and the last run before it that had a good one.
STATE = "run long, ord long, ok boolean, some boolean, good long"


def _follow(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
    import pandas as pd

    (source,) = key
    run, place, ok, some, good = state.get if state.exists else (None, None, None, None, None)
    rows = [r for frame in frames for r in zip(*(frame[c].tolist() for c in ("run", "ord", "ok")), strict=True)]
    out: dict[int, tuple] = {}
    # A source has a few fetches a run; those of a batch are taken in the order of runs, whatever order they came in.
    for r, o, fine in sorted(rows):
        if run is not None and r < run:
            continue  # late: its run is closed
        if run is None or r > run:
            run, place, ok, some, good = int(r), int(o), bool(fine), bool(fine), run if some else good
        else:
            some = some or bool(fine)
            if o >= place:
                place, ok = int(o), bool(fine)
        kept = run if ok else good
        out[run] = (source, run, ok, kept, not ok and good is not None)
    if run is not None:
        state.update((run, place, ok, some, good))
    if out:
        taken = pd.DataFrame(list(out.values()), columns=["source_id", "run", "ok", "taken", "used_cache"])
        yield taken.astype({"run": "int64", "ok": "bool", "taken": "Int64", "used_cache": "bool"})


def last_good_runs(fetches: DataFrame) -> DataFrame:
    """Of a stream of fetch results (run, source_id, ok, ord) each source's outcome of a run, given anew whenever it changes: source_id, run, ok, taken, used_cache.

    ``taken`` is the run whose records the source goes on with: the run itself if its last fetch was good, else the last run before that had a good
    one, else null. Runs of a source arrive in order; results of a run that is closed are late and are left out. One small row is held per source.
    """
    rows = fetches.selectExpr("source_id", "CAST(run AS LONG) AS run", "CAST(ord AS LONG) AS ord", "ok").where("source_id IS NOT NULL AND run IS NOT NULL AND ord IS NOT NULL AND ok IS NOT NULL")
    return rows.groupBy("source_id").applyInPandasWithState(_follow, RESULT, STATE, "update", GroupStateTimeout.NoTimeout)

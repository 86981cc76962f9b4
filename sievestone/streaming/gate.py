"""The gate against persistent violations as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "bad INT, clear INT, alerted BOOLEAN"
EVENTS = "frame BIGINT, track_id BIGINT, event STRING, missing ARRAY<STRING>, confirmed BOOLEAN"


def gate_processor(confirm: int, clear: int, ttl_ms: int | None):
    class Gate(StatefulProcessor):
        """Counts of one track; rows of a micro-batch are taken in the order of frames."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("gate", STATE, ttl_ms) if ttl_ms else handle.getValueState("gate", STATE)

        def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
            import pandas as pd

            bad, ok, alerted = self.state.get() if self.state.exists() else (0, 0, False)
            out = []
            for frame, missing in sorted(((int(f), list(m)) for pdf in rows for f, m in zip(pdf["frame"], pdf["missing"])), key=lambda x: x[0]):
                if missing:
                    bad, ok = bad + 1, 0
                    if bad >= confirm and not alerted:
                        alerted = True
                        out.append((frame, int(key[0]), "violation", sorted(missing), True))
                else:
                    bad, ok = 0, ok + 1
                    alerted = alerted and ok < clear
            self.state.update((bad, ok, alerted))
            yield pd.DataFrame(out, columns=["frame", "track_id", "event", "missing", "confirmed"])

        def close(self) -> None:
            pass

    return Gate()


def fallback_track(frame: str = "frame_no", box: str = "idx"):
    """A negative id for a worker that no tracker knows: its status counts, it never raises an alert. A frame has room for a million boxes."""
    return -(F.shiftleft(F.col(frame).cast("long"), 20) + F.col(box) + 1)


def alerts(statuses: DataFrame, confirm: int = 3, clear: int = 2, ttl_ms: int | None = None) -> DataFrame:
    """Events of a stream of statuses (frame, track_id, missing): one for each episode. Rows without a track pass the gate by.

    State stays as long as a track exists, unless ttl_ms is given. Needs the RocksDB state store.
    """
    tracked = statuses.where("track_id >= 0").select("frame", "track_id", "missing")
    return tracked.groupBy("track_id").transformWithStateInPandas(gate_processor(confirm, clear, ttl_ms), EVENTS, "Append", "None")

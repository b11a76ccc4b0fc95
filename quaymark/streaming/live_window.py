"""The snapshot window on a live stream: per table the rows of the chunk in flight, until its high watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: A log entry: kind is ``row`` (of a chunk), ``low``, ``high`` or ``event``.
ENTRY = "table string, position long, kind string, chunk_id string, row_key string, payload string"
EMITTED = "table string, chunk_id string, row_key string, payload string"


class WindowProcessor(StatefulProcessor):
    """idle, buffered, open, idle: rows are held, events between the marks evict them, the high mark emits the rest.

    Marks of other chunks than the one in flight, as a replay brings them, change nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.phase = handle.getValueState("phase", "state string, chunk_id string")
        self.rows = handle.getMapState("rows", "row_key string", "ord long, payload string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        entries = pd.concat(list(rows)).sort_values("position", kind="stable")  # a batch comes in any order
        state, chunk = self.phase.get() if self.phase.exists() else ("idle", "")
        out = []
        for e in entries.itertuples(index=False):
            if e.kind == "row" and (state == "idle" or state == "buffered" and e.chunk_id == chunk):
                if state == "buffered" and self.rows.containsKey((e.row_key,)):
                    raise ValueError(f"chunk {chunk} has a key twice; chunk boundaries overlap")
                state, chunk = "buffered", e.chunk_id
                self.rows.updateValue((e.row_key,), (int(e.position), e.payload))
            elif e.kind == "low" and state == "buffered" and e.chunk_id == chunk:
                state = "open"
            elif e.kind == "event" and state == "open" and self.rows.containsKey((e.row_key,)):
                self.rows.removeKey((e.row_key,))
            elif e.kind == "high" and state == "open" and e.chunk_id == chunk:
                held = sorted(((v[0], k[0], v[1]) for k, v in self.rows.iterator()))
                out += [(key[0], chunk, k, payload) for _, k, payload in held]
                self.rows.clear()
                state, chunk = "idle", ""
        self.phase.update((state, chunk))
        yield pd.DataFrame(out, columns=["table", "chunk_id", "row_key", "payload"])

    def close(self) -> None:
        pass


def live_window(entries: DataFrame) -> DataFrame:
    """Surviving snapshot rows of a stream of ENTRY rows; needs the RocksDB state store provider."""
    return entries.groupBy("table").transformWithStateInPandas(WindowProcessor(), EMITTED, "Append", "None")

"""Running numbers of blocks that arrive as a stream: what was merged, and the next free id, are kept as keyed state.

A block's ids go on where those of the blocks before it end. Blocks that come again (a stage that was run twice, a file that was
written twice) keep the numbers they have and give no row. State and progress lie in the stream's checkpoint, so a query
that is stopped and started again goes on with the ids of one that never stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The provider of state that processors of this kind need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Numbering(StatefulProcessor):
    """State of one volume: the next free id, and each merged block's first id."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next_id", "next_id long")
        self.merged = handle.getMapState("merged", "idx long", "first_id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (the interface's names)
        blocks = pd.concat(list(rows)).dropna(subset=["idx", "max_id"]).sort_values(["idx", "max_id"], ascending=[True, False]).drop_duplicates("idx")
        free = self.next.get()[0] if self.next.exists() else 1
        found = []
        for idx, size in zip(blocks["idx"].astype(int).tolist(), blocks["max_id"].astype(int).tolist()):
            if not self.merged.containsKey((idx,)):
                self.merged.updateValue((idx,), (free,))
                found.append((key[0], idx, free - 1, size))
                free += size
        self.next.update((free,))
        if found:
            yield pd.DataFrame(found, columns=["volume", "idx", "offset", "max_id"])

    def close(self) -> None:
        pass


def numbered_blocks(stream: DataFrame) -> DataFrame:
    """``volume, idx, offset, max_id``: what to add to the local ids of each block that wasn't seen before.

    ``stream``: ``volume`` (text), ``idx`` and ``max_id`` of finished blocks. Blocks of one trigger are numbered by ``idx``; one that comes twice in it counts
    with its greatest ``max_id``; rows without ``idx`` or ``max_id`` are left out; a null volume is a volume of its own. A volume's rows are a few bytes a
    block, and volumes are spread over tasks. The session's state store has to be ``PROVIDER`` when the query starts.
    """
    return stream.groupBy("volume").transformWithStateInPandas(Numbering(), "volume string, idx long, offset long, max_id long", outputMode="Append", timeMode="None")


def run_numbering(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Number all blocks that have arrived, append them to the Parquet table ``out``, and stop; ``checkpoint`` is where the next call goes on."""
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, PROVIDER)
    try:
        query = numbered_blocks(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)

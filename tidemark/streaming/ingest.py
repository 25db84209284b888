"""Streams: files into a stored table, first rows by id, and ledgers replayed with state."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidemark.operators.portfolio import REPLAYED, replay
from tidemark.sources.sinks import StoredTable


#: Settings of streams whose state stays on disk.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


#: Order of transactions with the same seq, as in portfolio.rank.
MONEY_IN = {"DEPOSIT": 1, "SELL": 2, "BUY": 3, "WITHDRAW": 4}


def upserted(stream: DataFrame, path: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Takes all that is there and upserts each batch; a batch that is run again gives the same table, as the merge can be replayed."""
    table = StoredTable(stream.sparkSession, path)

    def take(batch: DataFrame, _: int) -> None:
        table.upsert(batch, keys, order)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_by_id(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """One row for each id within the delay of its time; the state of older ids is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


class FirstWrite(StatefulProcessor):
    """Passes the first row of an id on, by order within a batch, and none ever after."""

    def __init__(self, columns: list[str], order: list[str]):
        self.columns, self.order = columns, order

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues):
        known, best = self.seen.exists(), None
        for part in rows:
            if not known and len(part):
                first = part.sort_values(self.order, kind="stable").iloc[:1]
                best = first if best is None else pd.concat([best, first]).sort_values(self.order, kind="stable").iloc[:1]
        if best is not None:
            self.seen.update((True,))
            yield best[self.columns]

    def close(self) -> None:
        pass


def first_writes(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each id, for good: state by id without expiry, on disk (needs RocksDB state, see ROCKS).

    Of an id's rows in one batch the first by order counts. Rows without an id are left out.
    """
    columns = stream.columns
    return stream.where(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(FirstWrite(columns, order), stream.schema, "append", "none")


def replayed(stream: DataFrame, rate: float = 0.011) -> DataFrame:
    """REPLAYED for a stream of transactions (portfolio, seq, type, symbol, quantity, price); a batch's rows are taken in order of seq, the state holds cash and shares."""
    order = ["seq", "type", "symbol", "quantity", "price"]

    def run(key: tuple, frames: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        state = {"cash": 0.0, "held": {}}
        if group.exists:
            state["cash"], held = group.get
            state["held"] = {k: tuple(v) for k, v in json.loads(held).items()}
        rows = pd.concat(list(frames))[["portfolio", *order]]
        rows = rows.assign(rank_=rows["type"].map(MONEY_IN).fillna(9)).sort_values(["seq", "rank_", *order[1:]])[["portfolio", *order]]
        rows = rows.astype(object).where(rows.notna(), None)
        out = replay(rows.itertuples(index=False, name=None), state, rate)
        group.update((state["cash"], json.dumps(state["held"])))
        yield pd.DataFrame(out, columns=[f.split()[0] for f in REPLAYED.split(", ")])

    return stream.groupBy("portfolio").applyInPandasWithState(run, REPLAYED, "cash double, held string", "append", GroupStateTimeout.NoTimeout)


def file_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)

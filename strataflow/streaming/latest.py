"""Type 1 as streaming state: the newest row of each key, kept by an aggregate.

The state is the table. It lies on disk beside the checkpoint (RocksDB), never expires,
and changes together with the batch, so a repeated batch changes nothing and no file of
rows is rewritten: a batch costs what it brings. The rows are read from the state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from strataflow.operators.scd import sequenced, tie_columns
from strataflow.sources.schema import SchemaStore

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class LatestTable:
    """The row with the greatest sequence of each key, over a stream of change rows.

    Rows with equal sequence go by a total order over the other columns, as in
    :func:`strataflow.operators.scd.latest`. Rows without a key or sequence are left out.
    The columns are those of the first update.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], sequence_by: str, compare_last: Iterable[str] = ()
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.sequence_by = sequence_by
        self.compare_last = list(compare_last)
        self.store = SchemaStore(spark, f"{self.path}/schema")

    def update(self, changes: DataFrame) -> None:
        """Take in what the stream has brought since the last update."""
        known = self.store.load()
        if known is not None and known != changes.schema:
            raise ValueError(f"{self.path} has columns {known.simpleString()}, not {changes.schema.simpleString()}")
        self.store.save(changes.schema)
        order = [F.col(f"`{self.sequence_by}`"), *tie_columns(changes, self.keys, self.sequence_by, self.compare_last)]
        row = F.struct(*[F.col(f"`{c}`") for c in changes.columns if c not in self.keys])
        newest = sequenced(changes, self.keys, self.sequence_by).groupBy(*self.keys).agg(F.max_by(row, F.struct(*order)).alias("row"))
        with _settings(self.spark):
            (
                newest.writeStream.format("noop").outputMode("update")
                .option("checkpointLocation", f"{self.path}/checkpoint")
                .trigger(availableNow=True).start().awaitTermination()
            )

    def read(self) -> DataFrame:
        schema = self.store.load()
        if schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        with _settings(self.spark):
            held = self.spark.read.format("statestore").load(f"{self.path}/checkpoint")
        value = held.schema["value"].dataType
        assert isinstance(value, StructType)
        rows = held.select(*[F.col(f"key.`{k}`").alias(k) for k in self.keys], F.col(f"value.`{value.names[0]}`").alias("_row"))
        return rows.select(*[F.col(f"`{c}`") if c in self.keys else F.col(f"_row.`{c}`").alias(c) for c in schema.names])

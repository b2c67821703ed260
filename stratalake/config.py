"""Names, keys and per-run configuration shared by every layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# Column names, keys and formats of the trip tables.
PARTITION_COLUMNS = ("year", "month")
DEDUP_KEYS = ("vendorid", "pickup_ts", "dropoff_ts", "source_file")
MERGE_KEYS = ("vendorid", "pickup_ts", "dropoff_ts")
SUMMARY_KEYS = ("year", "month", "payment_type")
LATEST_ARRIVAL = ("ingestion_timestamp", "source_file")
RESCUED = "rescued_record"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("vendorid", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.StringType()),
        T.StructField("tpep_dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.StringType()),
        T.StructField("trip_distance", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

# Merge keys that can be NULL. The two timestamps, the year and the month cannot:
# the date filter removes such rows before they reach Silver.
NULLABLE_MERGE_KEYS = ("vendorid",)
NULLABLE_SUMMARY_KEYS = ("payment_type",)


@dataclass(frozen=True)
class Layer:
    """One stored table: where it lives, its catalog name, and how it is laid out."""

    path: str
    database: str | None = None
    table: str | None = None
    database_location: str | None = None
    partition_columns: tuple[str, ...] = PARTITION_COLUMNS
    keys: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "path", self.path.rstrip("/"))

    @property
    def qualified_name(self) -> str | None:
        if self.database is None or self.table is None:
            return None
        return f"`{self.database}`.`{self.table}`"


@dataclass(frozen=True)
class PipelineConfig:
    """Everything the three layer runs need.

    ``dropzone`` is one directory (or glob) or a list of them. ``schema`` declares the raw
    columns; left out, column names come from the header, the known trip columns get their
    declared type and all others stay text. ``infer_schema`` asks Spark to infer instead,
    which costs a second pass over the files.

    ``on_conflict`` decides what Silver does when several source rows share a merge key:
    ``"latest"`` keeps the last one in ``survivor_order`` (the first one if not
    ``survivor_descending``), ``"fail"`` raises.

    With ``gold_state`` Silver upserts also keep the rows that they replace and bring, in a folder beside Silver, and Gold is
    brought up to date from these rows and the stored parts of its totals, without reading Silver.

    With ``rescue`` Bronze has one more column, ``rescued_record``: the whole record of a row in which a value did not fit
    its column, or with too few or too many values. Such rows go to the quarantine instead of Silver.

    ``exact_amounts`` is ``exact`` of :func:`stratalake.operators.monthly_summary`.
    """

    dropzone: str | Sequence[str]
    bronze: Layer
    silver: Layer
    gold: Layer
    quarantine: Layer | None = None
    schema: T.StructType | None = None
    infer_schema: bool = False
    on_empty: str = "warn"
    on_conflict: str = "latest"
    survivor_order: tuple[str, ...] = LATEST_ARRIVAL
    survivor_descending: bool = True
    exact_amounts: bool | str = True
    gold_state: Layer | None = None
    rescue: bool = False

    @property
    def silver_changes(self) -> str | None:
        """The folder of the rows that Silver upserts replaced and brought and that Gold has yet to take in."""
        return f"{self.silver.path}.changes" if self.gold_state else None

    def __post_init__(self) -> None:
        if self.on_empty not in ("warn", "fail"):
            raise ValueError(f"on_empty must be 'warn' or 'fail', not {self.on_empty!r}")
        if self.gold_state and not self.exact_amounts:
            raise ValueError("only exact amounts can be added and taken away again")
        if self.on_conflict not in ("latest", "fail"):
            raise ValueError(f"on_conflict must be 'latest' or 'fail', not {self.on_conflict!r}")


def standard_layers(
    root: str, databases: tuple[str, str, str] = ("bronze", "silver", "gold"), table: str = "trips"
) -> tuple[Layer, Layer, Layer]:
    """Bronze, Silver and Gold layers below one root folder."""
    root = root.rstrip("/")
    keys = ((), MERGE_KEYS, SUMMARY_KEYS)
    return tuple(
        Layer(
            path=f"{root}/{name}/{table}",
            database=database,
            table=table,
            database_location=f"{root}/{name}",
            keys=layer_keys,
        )
        for name, database, layer_keys in zip(("bronze", "silver", "gold"), databases, keys)
    )

"""DataFrame -> DataFrame steps. None of them touches storage."""

from stratalake.operators.changes import Changes, change_rows, replaced_rows
from stratalake.operators.clean import (
    clean_trips,
    conform_trips,
    fitting_trips,
    rejected_trips,
    typed_trips,
    with_trip_period,
    with_valid_dates,
)
from stratalake.operators.dedup import DuplicateKeyError, any_per_key, first_per_key, key_conflicts, require_unique
from stratalake.operators.enrich import with_lineage, with_pickup_date
from stratalake.operators.files import matching_files
from stratalake.operators.merge import (
    inserted_rows,
    merge_frames,
    retained_rows,
    updated_rows,
)
from stratalake.operators.metrics import StepCount, measure_while, step_report
from stratalake.operators.schema import Reconciled, SchemaConflictError, aligned, reconcile
from stratalake.operators.summary import monthly_summary, preview

__all__ = [
    "Changes",
    "DuplicateKeyError",
    "Reconciled",
    "SchemaConflictError",
    "StepCount",
    "aligned",
    "any_per_key",
    "change_rows",
    "clean_trips",
    "conform_trips",
    "first_per_key",
    "fitting_trips",
    "inserted_rows",
    "key_conflicts",
    "matching_files",
    "measure_while",
    "merge_frames",
    "monthly_summary",
    "preview",
    "reconcile",
    "rejected_trips",
    "replaced_rows",
    "require_unique",
    "retained_rows",
    "step_report",
    "typed_trips",
    "updated_rows",
    "with_lineage",
    "with_pickup_date",
    "with_trip_period",
    "with_valid_dates",
]

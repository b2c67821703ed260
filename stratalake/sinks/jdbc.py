"""Export of a result table to a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
    keep_definition: bool = True,
) -> dict[str, str]:
    """Options of Spark's JDBC writer.

    ``connections`` bounds the parallel connections: Spark merges partitions beyond it.
    ``keep_definition`` empties the table on overwrite instead of dropping it, so its key
    constraint, indexes and grants stay.
    """
    if not url.startswith("jdbc:"):
        raise ValueError(f"not a JDBC address: {url!r}")
    if connections < 1 or batch_size < 1:
        raise ValueError("connections and batch_size must be positive")
    options = {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": str(keep_definition).lower(),
    }
    given = {"driver": driver, "user": user, "password": password}
    return options | {name: value for name, value in given.items() if value is not None}


def export_jdbc(rows: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    """Write ``rows`` to ``table``; ``options`` are those of :func:`jdbc_options`.

    Each partition is one transaction. If an executor is lost right after its commit, Spark runs
    that partition again. A unique key on the table turns the repeated rows into an error, and
    the overwrite can then simply be run once more.
    """
    rows.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode(mode).save()

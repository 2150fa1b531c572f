"""Publishing to a relational serving store through Spark's JDBC writer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from marquee.specs import KPIS, SERVED_RUN_LOG

# Types of the serving columns for a store that does not have the tables yet, wide enough for every
# value; other columns get Spark's default. ``serving.sql`` declares the tables with key and index.
SERVING_TYPES = {
    KPIS: (
        "nconst VARCHAR(32), role VARCHAR(32), average_rating DECIMAL(14, 5), "
        "total_run_time_minutes BIGINT, total_titles_as_principal BIGINT"
    ),
    SERVED_RUN_LOG: "stage VARCHAR(64), table_name VARCHAR(64), date DATE, status VARCHAR(32)",
}


@dataclass(frozen=True)
class JdbcTarget:
    """A database to publish to. ``connections`` bounds how many tasks write at the same time."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    connections: int = 16
    options: dict[str, str] = field(default_factory=dict)

    def overwrite(self, df: DataFrame, dbtable: str) -> None:
        """Replace the rows of ``dbtable``, creating it with its serving types if it is not there.

        An existing table is truncated, not dropped, so that its key, index and types remain.
        """
        settings = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": dbtable,
            "truncate": "true",
            "numPartitions": str(self.connections),
            "user": self.user,
            "password": self.password,
            "createTableColumnTypes": SERVING_TYPES.get(dbtable),
            **self.options,
        }
        given = {name: value for name, value in settings.items() if value is not None}
        df.write.format("jdbc").options(**given).mode("overwrite").save()

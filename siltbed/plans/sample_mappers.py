"""Sample mappers of the two kinds a job can name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions import field_at
from siltbed.operators.mapping import register_mapper, row_mapper, table_mapper
from siltbed.operators.settle import settle

TYPE_FIELD = 2
DEFAULT_ALERT_TYPES = ("error", "purchase")


@register_mapper("event_type", inputs=("value",))
def event_type_mapper(log: DataFrame, *, prefix: str = "by_type") -> DataFrame:
    """One route per event type; messages without one are dropped."""
    event_type = field_at(F.col("value"), TYPE_FIELD)
    routed = settle(log, route=F.concat(F.lit(prefix + "/"), event_type))
    return routed.where(F.col("route").isNotNull()).select(
        "topic", "partition", "offset", "route", F.col("value").alias("line")
    )


@register_mapper("alerts", inputs=("value",))
def alert_mapper(log: DataFrame, *, alert_types: tuple[str, ...] = DEFAULT_ALERT_TYPES) -> DataFrame:
    """Every message to ``all``, and alerts of the given types to a second route as well."""
    typed = settle(log, event_type=field_at(F.col("value"), TYPE_FIELD))
    event_type = F.col("event_type")
    alert = F.when(event_type.isin(*alert_types), F.concat(F.lit("alerts/"), event_type))
    routes = F.array_compact(F.array(F.lit("all"), alert))
    return typed.where(F.col("value").isNotNull()).select(
        "topic", "partition", "offset", F.explode(routes).alias("route"), F.col("value").alias("line")
    )


def alert_rows_handler() -> type:
    """The ``alerts`` rule as a row-mapper class, one call per message.

    Built in a function so that it travels with the query by value, and executors
    need not have this package installed.
    """

    class AlertRows:
        def eval(self, topic, partition, next_offset, key, message, parameters):
            if message is None:
                return
            yield "all", message
            fields = message.split(",")
            if len(fields) > TYPE_FIELD and fields[TYPE_FIELD] in DEFAULT_ALERT_TYPES:
                yield f"alerts/{fields[TYPE_FIELD]}", message

    return AlertRows


def alert_table_handler() -> type:
    """The rule again with a set-up call, which takes the types and the folder from the job's parameters."""

    class AlertTable:
        @staticmethod
        def check(parameters):
            if not isinstance(parameters.get("types", []), list):
                raise ValueError("types must be a list")

        def configure(self, topic, output, parameters):
            self.types, self.folder = parameters.get("types", DEFAULT_ALERT_TYPES), parameters.get("folder", "alerts")

        def eval(self, partition, next_offset, key, message):
            if message is None:
                return
            yield "all", message
            fields = message.split(",")
            if len(fields) > TYPE_FIELD and fields[TYPE_FIELD] in self.types:
                yield f"{self.folder}/{fields[TYPE_FIELD]}", message

    return AlertTable


register_mapper("alert_table")(table_mapper(alert_table_handler()))
register_mapper("alert_rows")(row_mapper(alert_rows_handler()))

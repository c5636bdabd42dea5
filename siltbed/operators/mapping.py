"""Mappers: which output bucket each log message goes to.

A mapper is a DataFrame -> DataFrame function over log rows (topic, partition,
offset, key, value). It returns zero or more rows per message with at least

    topic, partition, offset, line, <bucket columns>

and may add ``reject_reason``; rows where it is not NULL go to quarantine
instead of the landed table. Mappers are chosen by name from a registry and
receive the job's parameters as keyword arguments.
"""

from __future__ import annotations

import importlib
import inspect
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeResult

from siltbed.functions import (
    DEFAULT_UTC_OFFSET_HOURS,
    field_at,
    field_count,
    hour_route,
    in_supported_range,
    local_day,
    local_hour,
    strict_long,
)
from siltbed.operators.settle import settle
from siltbed.schema import HOUR_BUCKETS, ROUTE_BUCKETS

if TYPE_CHECKING:
    import pyarrow as pa

# Fixed values of the message contract: the event time is field 9 (zero-based)
# and a message of fewer than 9 fields is dropped before it is parsed. A message
# of exactly 9 fields therefore has no event time.
TIMESTAMP_INDEX = 9
MIN_FIELDS = 9

NULL_VALUE = "null_value"
TOO_FEW_FIELDS = "too_few_fields"
BAD_TIMESTAMP = "bad_timestamp"
OUT_OF_RANGE = "timestamp_out_of_range"


@dataclass(frozen=True)
class Mapper:
    name: str
    transform: Callable[..., DataFrame]
    buckets: T.StructType
    inputs: tuple[str, ...] = ("key", "value")
    total: bool = False

    def __call__(self, log: DataFrame, **parameters) -> DataFrame:
        return self.transform(log, **parameters)

    def takes(self, parameter: str) -> bool:
        accepted = inspect.signature(self.transform).parameters.values()
        return any(p.name == parameter or p.kind is p.VAR_KEYWORD for p in accepted)


_REGISTRY: dict[str, Mapper] = {}


def register_mapper(
    name: str,
    buckets: T.StructType = ROUTE_BUCKETS,
    *,
    inputs: tuple[str, ...] = ("key", "value"),
    total: bool = False,
):
    """Decorator: make a DataFrame transform available to jobs under ``name``.

    ``inputs`` are the message columns it reads; a stream fetches no others.
    ``total`` promises exactly one output row, landed or rejected, for every
    message, with the message as its line, which lets a job learn a batch's
    offsets and size from what it wrote.
    """

    def add(transform: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _REGISTRY[name] = Mapper(name, transform, buckets, inputs, total)
        return transform

    return add


def get_mapper(name: str | Mapper) -> Mapper:
    """A mapper by its registered name, or by ``module:name``, which imports the module first.

    After the colon stands a name that the module registers, or its own name of
    a ``Mapper`` or of a class with ``eval`` (see ``row_mapper``, and ``table_mapper`` if it has ``configure`` too).
    """
    if isinstance(name, Mapper):
        return name
    module, colon, own = name.partition(":")
    if colon:
        found = getattr(importlib.import_module(module), own, None)
        if isinstance(found, Mapper):
            return found
        if isinstance(found, type) and hasattr(found, "eval"):
            adapt = table_mapper if hasattr(found, "configure") else row_mapper
            return Mapper(name, adapt(found), ROUTE_BUCKETS)
        name = own
    if name not in _REGISTRY:
        raise ValueError(f"no mapper named {name!r}; registered: {sorted(_REGISTRY)}")
    return _REGISTRY[name]


@register_mapper("csv_hour", buckets=HOUR_BUCKETS, inputs=("value",), total=True)
def csv_hour_mapper(
    log: DataFrame,
    *,
    delimiter: str = ",",
    ts_index: int = TIMESTAMP_INDEX,
    min_fields: int = MIN_FIELDS,
    utc_offset_hours: int = DEFAULT_UTC_OFFSET_HOURS,
) -> DataFrame:
    """Route each message to the local hour of the epoch-millisecond field at ``ts_index``.

    The message text is passed on unchanged as ``line``. Extra columns of
    ``log`` are kept.
    """
    value, n_fields, event_ms = F.col("value"), F.col("_n_fields"), F.col("_event_ms")
    parsed = (
        log.withColumn("_n_fields", field_count(value, delimiter))
        .withColumn("_ts_text", field_at(value, ts_index, delimiter, n_fields))
        .withColumn("_event_ms", strict_long(F.col("_ts_text")))
    )
    reason = (
        F.when(value.isNull(), NULL_VALUE)
        .when(n_fields < min_fields, TOO_FEW_FIELDS)
        .when(event_ms.isNull(), BAD_TIMESTAMP)
        .when(~in_supported_range(event_ms), OUT_OF_RANGE)
    )
    judged = settle(
        parsed,
        reject_reason=reason,
        # Out-of-range values are cleared here, so the arithmetic below cannot overflow.
        _event_ms=F.when((n_fields >= min_fields) & in_supported_range(event_ms), event_ms),
    )
    kept = [c for c in log.columns if c != "value"]
    return judged.select(
        *kept,
        (F.col("offset") + 1).alias("next_offset"),
        value.alias("line"),
        "reject_reason",
        local_day(event_ms, utc_offset_hours).alias("event_day"),
        local_hour(event_ms, utc_offset_hours).alias("event_hour"),
    ).withColumn("route", hour_route(F.col("event_day"), F.col("event_hour")))


def accepted(mapped: DataFrame) -> DataFrame:
    return mapped.where(F.col("reject_reason").isNull())


def rejected(mapped: DataFrame) -> DataFrame:
    return mapped.where(F.col("reject_reason").isNotNull())


# Output rows handed back to Spark at a time, so that a large fan-out does not pile up.
ROWS_PER_BATCH = 10_000


def row_mapper(handler: type) -> Callable[..., DataFrame]:
    """Mapper from a Python class, for logic that columns cannot express.

    One ``handler()`` is made per task. Its ``eval(topic, partition, next_offset,
    key, message, parameters)`` yields any number of ``(route, line)`` pairs;
    ``parameters`` is the job's parameters as a JSON object. Messages and results
    cross in Arrow batches, but eval runs once per message: prefer a column
    transform where there is one.
    """

    def transform(log: DataFrame, **parameters) -> DataFrame:
        text, limit = json.dumps(parameters, sort_keys=True), ROWS_PER_BATCH

        # Everything it needs is imported or closed over here: executors may not have this package.
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow as pa

            def flush(batch, picked, routes, lines):
                origin = [batch.column(i).take(pa.array(picked, pa.int64())) for i in range(3)]
                results = [pa.array(routes, pa.string()), pa.array(lines, pa.string())]
                return pa.RecordBatch.from_arrays(
                    origin + results, names=["topic", "partition", "offset", "route", "line"]
                )

            mapper = handler()
            for batch in batches:
                picked, routes, lines = [], [], []
                messages = zip(*(column.to_pylist() for column in batch.columns), strict=True)
                for i, (topic, partition, offset, key, message) in enumerate(messages):
                    for route, line in mapper.eval(topic, partition, offset + 1, key, message, text):
                        picked.append(i)
                        routes.append(route)
                        lines.append(line)
                        if len(picked) == limit:
                            yield flush(batch, picked, routes, lines)
                            picked, routes, lines = [], [], []
                yield flush(batch, picked, routes, lines)

        rows = log.select("topic", "partition", "offset", "key", "value")
        return rows.mapInArrow(run, "topic string, partition int, offset bigint, route string, line string")

    return transform


def table_mapper(handler: type) -> Callable[..., DataFrame]:
    """Mapper from a Python class that is set up once, as a table function joined to the log laterally.

    One ``handler()`` is made per task and topic. ``configure(topic, output,
    parameters)`` is called on it before its first message, with the job's output
    root and its parameters, parsed when the query is analysed: parameters that
    are no JSON object, or that the class's optional ``check(parameters)`` refuses,
    fail before any task starts. ``eval(partition, next_offset, key, message)``
    yields any number of ``(route, line)`` pairs.
    """

    def transform(log: DataFrame, *, output: str = "", **parameters) -> DataFrame:
        @dataclass
        class Configured(AnalyzeResult):
            settings: dict = field(default_factory=dict)

        class Mapped:
            @staticmethod
            def analyze(topic, partition, next_offset, key, message, output, parameters):
                settings = json.loads(parameters.value)
                if hasattr(handler, "check"):
                    handler.check(settings)
                columns = T.StructType([T.StructField(name, T.StringType()) for name in ("route", "line")])
                return Configured(schema=columns, settings=settings)

            def __init__(self, configured):
                self.settings, self.handlers = configured.settings, {}

            def eval(self, topic, partition, next_offset, key, message, output, parameters):
                if topic not in self.handlers:
                    self.handlers[topic] = handler()
                    self.handlers[topic].configure(topic, output, self.settings)
                yield from self.handlers[topic].eval(partition, next_offset, key, message)

        names = ("topic", "partition", "offset", "key", "value")
        topic, partition, offset, key, value = (F.col(name).outer() for name in names)
        settings = (F.lit(output), F.lit(json.dumps(parameters, sort_keys=True)))
        mapped = udtf(Mapped)(topic, partition, offset + 1, key, value, *settings)
        return log.select(*names).lateralJoin(mapped).select("topic", "partition", "offset", "route", "line")

    return transform

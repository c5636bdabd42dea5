from siltbed.streaming.landing import LandingJob, OutOfOrderError
from siltbed.streaming.ledger import FencedWriterError, OffsetLedger
from siltbed.streaming.sinks import (
    append_log_files,
    export_named_text,
    export_text,
    payload_of,
    produce,
    producer_options,
    producer_payload,
    read_named_text,
    read_text,
)
from siltbed.streaming.tables import read_landed, read_rejected, write_messages

__all__ = [
    "FencedWriterError",
    "LandingJob",
    "OffsetLedger",
    "OutOfOrderError",
    "append_log_files",
    "export_named_text",
    "export_text",
    "payload_of",
    "produce",
    "producer_options",
    "producer_payload",
    "read_landed",
    "read_rejected",
    "read_named_text",
    "read_text",
    "write_messages",
]

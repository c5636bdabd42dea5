from siltbed.sources.log import (
    FileLog,
    FrameLog,
    KafkaLog,
    decode_messages,
    kafka_starting_offsets,
    print_tail,
    tail_line,
    tail_log,
)

__all__ = [
    "FileLog",
    "FrameLog",
    "KafkaLog",
    "decode_messages",
    "kafka_starting_offsets",
    "print_tail",
    "tail_line",
    "tail_log",
]

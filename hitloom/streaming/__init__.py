from hitloom.streaming.run import (
    decode_stream,
    read_kafka,
    run_local,
    run_stream,
    state_size,
    unique_events,
    use_bounded_state,
)

__all__ = [
    "decode_stream",
    "read_kafka",
    "run_local",
    "run_stream",
    "state_size",
    "unique_events",
    "use_bounded_state",
]

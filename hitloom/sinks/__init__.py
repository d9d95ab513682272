from hitloom.sinks.committed import CommittedBatches, read_committed
from hitloom.sinks.tables import to_kafka_rows, write_event_table, write_events

__all__ = ["CommittedBatches", "read_committed", "to_kafka_rows", "write_event_table", "write_events"]

from hitloom.sources.curves import read_curve, read_curves
from hitloom.sources.events import read_events, read_hit_keys
from hitloom.sources.maps import read_channel_map
from hitloom.sources.messages import capture_messages, decode_events, offset_summary
from hitloom.sources.paths import Paths

__all__ = [
    "Paths",
    "capture_messages",
    "decode_events",
    "offset_summary",
    "read_channel_map",
    "read_curve",
    "read_curves",
    "read_events",
    "read_hit_keys",
]

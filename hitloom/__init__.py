"""Detector event analysis as Spark DataFrame jobs.

Raw events (nested readout) are flattened to hits, mapped to detector channels, corrected for the
module's time reference, paired into pulses, calibrated, turned into positions, gathered to one row
per event and histogrammed.  Every step is a function ``DataFrame -> DataFrame``.
"""

from hitloom.schema import CHANNEL_KEY, EVENT_KEY, MODULE_KEY, RAW_EVENT

__all__ = ["CHANNEL_KEY", "EVENT_KEY", "MODULE_KEY", "RAW_EVENT"]

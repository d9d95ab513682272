from hitloom.operators.calibration import linear_calib, linear_calib_array, to_float
from hitloom.operators.chunks import chunked
from hitloom.operators.curves import interpolate
from hitloom.operators.events import assemble, collect_planes, distinct_events
from hitloom.operators.histograms import (
    Histogram,
    hist1d,
    hist1d_stats,
    hist2d,
    hist2d_stats,
    histograms,
    zip_arrays,
)
from hitloom.operators.hits import explode_hits, flip_edges, map_channels, validate
from hitloom.operators.pairing import pair_edges
from hitloom.operators.reference import subtract_by_id, subtract_reference, time_reference
from hitloom.operators.strips import strip_position, top2_strips
from hitloom.operators.triggers import trigger_chunks, trigger_table
from hitloom.operators.two_sided import two_sided

__all__ = [
    "Histogram",
    "assemble",
    "chunked",
    "collect_planes",
    "distinct_events",
    "explode_hits",
    "flip_edges",
    "hist1d",
    "hist1d_stats",
    "hist2d",
    "hist2d_stats",
    "histograms",
    "interpolate",
    "linear_calib",
    "linear_calib_array",
    "map_channels",
    "pair_edges",
    "strip_position",
    "subtract_by_id",
    "subtract_reference",
    "time_reference",
    "to_float",
    "top2_strips",
    "trigger_chunks",
    "trigger_table",
    "two_sided",
    "validate",
    "zip_arrays",
]

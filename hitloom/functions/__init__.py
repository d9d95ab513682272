from hitloom.functions.columns import (
    asymmetry,
    band_cell,
    band_cells,
    bin_edge,
    bin_guess,
    bin_number,
    dithered,
    flipped_edge,
    in_open_window,
    pair_features,
    strip_coordinate,
)

__all__ = [
    "asymmetry",
    "band_cell",
    "band_cells",
    "bin_edge",
    "bin_guess",
    "bin_number",
    "dithered",
    "flipped_edge",
    "in_open_window",
    "pair_features",
    "strip_coordinate",
]

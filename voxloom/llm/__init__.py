"""Training-data operators (token counts, dedup, packing, scans, scoring); nothing else in the package imports them."""

"""Bronze and silver streams, and the gold table recomputed from silver."""

"""Column functions and byte-level probes."""

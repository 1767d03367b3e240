"""Column-level helpers: bases and qualities, CIGAR strings, intervals."""

"""Plan shapes reused by several operators: skew handling, successors, intervals, medians."""

"""Column expressions: intervals, classification, estimates, sizes and names."""

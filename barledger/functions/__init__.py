"""Column expressions: value tests, quality rules, zone and text conversions."""

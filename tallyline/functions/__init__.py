"""Column-level helpers (I1-I13, C5, C6, K4): native expressions, plus the
Beta incomplete-function pandas UDFs used on aggregated rows only."""

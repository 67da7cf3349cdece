"""The three audience plans (Q1-Q3), presets, and the named driver queries."""

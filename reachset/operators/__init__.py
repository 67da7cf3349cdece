"""Audience algebra (joins, grouping, set operations) and output shaping."""

"""Reusable operators. They take and return DataFrames.

Two run a job when called, to store a small intermediate table: `totals.attach_group_total` and
`grouping.above_group_mean`.
"""

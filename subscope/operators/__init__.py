"""Reusable DataFrame operators.

The rule behind all of them: no task may need all rows of one key. Group
extremes and group statistics are aggregate-and-join instead of windows over
the key; sequences are numbered inside date buckets and stitched from bucket
totals; totals come from scalar subqueries.
"""

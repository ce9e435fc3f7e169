"""Incremental loads.

The workload has no unbounded streams: data arrives as whole seasons. What
lives here is the batch form of "process only what is new".
"""

"""Snapshot analytics on Spark: sweeps of job postings, their events, lifecycles and marts."""

"""Whole plans: the snapshot, the run, and the registered queries."""

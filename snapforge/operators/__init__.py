"""Operators over snapshots: comparison and entity resolution."""

"""Extension: snapshots compared as they arrive."""

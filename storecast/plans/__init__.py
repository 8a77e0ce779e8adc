"""Composed jobs, the bridge to the driver tables, and the query catalogue."""

"""Edges of the library: the activity fixture, table scans and sinks (snapshot, upsert), run logs and model files."""

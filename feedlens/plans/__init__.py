"""End-to-end analytics, the SQL formulation, and the registered query catalogue."""

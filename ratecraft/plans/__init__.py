"""Query plans over the driver tables: the role tables and the query catalogue."""

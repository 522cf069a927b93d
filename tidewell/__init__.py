"""tidewell: analytics jobs over lake tables, written as Spark DataFrame and SQL plans.

Packages
--------
functions   Column-level helpers (JSON text, ciphers, text, casts); no actions.
sources     Readers, writers, catalog work and data generators.
operators   DataFrame -> DataFrame building blocks (latest row, increments, joins, masks, ledger steps).
plans       Whole jobs put together from the operators.
streaming   The same transforms as Structured Streaming queries.
suite       The registered queries over the star-schema and text tables, with their SQL twins.

Library code never creates a session.  Settings it expects: session time zone UTC, ANSI on, AQE on.
"""

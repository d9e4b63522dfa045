"""SQL equivalents of the queries that SQL can express on whole tables."""

SQL: dict[str, str] = {}

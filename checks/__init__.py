"""The driver's queries on the given tables and their SQL counterparts."""

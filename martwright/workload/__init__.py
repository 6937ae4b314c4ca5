"""Queries over the shared test tables, one per operator or job, with SQL twins."""

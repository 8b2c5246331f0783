"""Queries over the test tables, one per operator, each with the SQL that checks it."""

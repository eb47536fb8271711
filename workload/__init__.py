"""Queries over the star-schema test tables, each with the SQL that must agree with it."""

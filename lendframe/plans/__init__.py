"""Registered queries over the test tables, each with its checking SQL where one exists."""

"""Registered queries over the test tables, each next to the SQL it has to agree with."""

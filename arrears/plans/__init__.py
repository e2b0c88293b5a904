"""Registered queries, each with the SQL it must agree with."""

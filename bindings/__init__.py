"""The operators bound to the test tables, each with an SQL oracle."""

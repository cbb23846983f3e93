"""The operators as queries on the test tables, each with SQL to check it."""

"""Views over the test tables, and the queries that exercise the operators."""

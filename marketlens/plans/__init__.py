"""The query catalogue over the test tables, and the SQL each query is checked against."""

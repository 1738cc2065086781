"""Readers and writers: delimited text, JDBC, sheets, paged records."""

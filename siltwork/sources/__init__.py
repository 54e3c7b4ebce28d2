"""Readers: files, JDBC tables, message topics and landing folders."""

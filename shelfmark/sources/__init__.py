"""Readers: files, service payloads, JDBC tables and the control table."""

"""Readers and writers: mapped source scans, JDBC, the table store."""

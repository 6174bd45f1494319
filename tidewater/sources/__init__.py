"""Readers: line topics, change logs, configuration changes, files, whole files and JDBC tables."""

"""Readers and writers for link lists, match tables, logs, page tables and the league catalog."""

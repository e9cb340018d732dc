"""Readers and writers: usage logs, saved service pages, date-partitioned copies."""

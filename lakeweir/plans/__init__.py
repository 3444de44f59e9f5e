"""Staging views, marts, incremental loads, contracts of the tables, and the refresh job."""

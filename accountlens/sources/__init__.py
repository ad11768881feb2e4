"""Readers, staging, rule tables and storage."""

"""Readers, stage tables and scratch storage."""

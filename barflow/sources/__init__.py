"""Readers, writers and bar resampling."""

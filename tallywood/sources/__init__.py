"""Readers: files and topics to typed DataFrames."""

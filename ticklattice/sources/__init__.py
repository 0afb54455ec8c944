"""Readers and writers of lanes, and parsing of wire messages."""

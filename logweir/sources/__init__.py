"""Readers: each turns a source description into a DataFrame."""

"""Readers that turn files, requests and the driver tables into canonical tables."""

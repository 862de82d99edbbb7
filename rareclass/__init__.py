"""Rare-event classification on large transaction tables, on Spark."""

"""Registered query plans (Spark) and their independent SQL oracles."""

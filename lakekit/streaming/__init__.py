"""Structured Streaming sources, dataset flows and change application."""

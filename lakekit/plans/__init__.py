"""Registered queries and the business plans they use."""

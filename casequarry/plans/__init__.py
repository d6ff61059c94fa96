"""Derived views, registered queries and their SQL."""

"""Marts, serving queries, the publishing job and the registry of checked queries."""

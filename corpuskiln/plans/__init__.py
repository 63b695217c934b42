"""Whole flows and registered queries."""

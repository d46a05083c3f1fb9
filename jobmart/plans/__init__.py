"""Flows and report measures composed from the operators."""

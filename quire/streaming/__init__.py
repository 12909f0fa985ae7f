"""Loads that pick up where they left off."""

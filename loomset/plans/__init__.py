"""Whole jobs: landing, preparation and the training load."""

"""Composite jobs: the reports and the clustering jobs users run."""

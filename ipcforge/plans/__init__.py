"""Composite jobs and reports."""

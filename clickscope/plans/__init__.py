"""Composite jobs (JOB1-JOB6) and the registry of named queries."""

"""Builders of facts and dimensions, and the analytic queries over them. No builder runs a job."""

"""Pipelines (bronze -> silver -> gold), the KPI model, dashboard queries and the query catalog."""

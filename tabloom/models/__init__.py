"""Fitting, scoring and inspecting models with Spark ML."""

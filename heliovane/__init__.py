"""Spark jobs that turn raw weather observations into solar and wind power reports."""

"""The reports and the jobs that feed them."""

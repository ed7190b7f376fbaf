"""Composed pipelines and the jobs that run them."""

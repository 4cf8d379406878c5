"""Views over source tables and jobs that chain operators."""

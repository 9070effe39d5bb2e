"""Composed jobs, stand-in views over the driver tables and the registered queries."""

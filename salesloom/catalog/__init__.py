"""Registered queries: each operator over the driver's tables, with the equivalent SQL."""

"""Composed plans: marts (M1-M18), serving queries (V1-V6), the payload
adapter over the supplied tables and the registered driver queries."""

"""Composed jobs (K1–K8) and the fixture views derived from the driver tables."""

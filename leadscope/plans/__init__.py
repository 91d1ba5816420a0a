"""Fixture views over the driver tables, the job catalogue, oracle SQL and broadcast sizing."""

"""Registered queries: each key pairs a Spark plan with an independent SQL oracle."""

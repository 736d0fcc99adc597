"""Composed plans (pipelines of operators) and the oracle SQL twins."""

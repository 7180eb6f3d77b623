"""Composed plans (bronze, silver, gold) and the query catalogue."""

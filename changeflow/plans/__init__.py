"""Test-table derivations, the registered queries and their oracle SQL."""

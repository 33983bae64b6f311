"""DataFrame operators: gates, the resolve kernel, reconciliation, metrics."""

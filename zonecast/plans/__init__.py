"""Composed plans: feature building, the forecast report, the query catalogue."""

"""Column-level building blocks: guards, time expressions, calendars, metrics."""

"""Composed steps, the view of the test tables, and the query catalogue."""

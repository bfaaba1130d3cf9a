"""The yearly job, and the query catalogue."""

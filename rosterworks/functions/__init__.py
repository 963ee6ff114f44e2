"""Part of the rosterworks library."""

"""The weekly runs as streams over the archive folder."""

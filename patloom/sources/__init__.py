"""Sources: archives, XML files, listings, tables."""

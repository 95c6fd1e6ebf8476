"""Writers for files and catalog tables."""

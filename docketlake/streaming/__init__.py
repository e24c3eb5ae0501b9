"""The incremental stages fed by newly arrived files."""

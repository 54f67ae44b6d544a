"""rosterline.sources."""

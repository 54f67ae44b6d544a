"""rosterline.streaming."""

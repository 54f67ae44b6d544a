"""rosterline.operators."""

"""rosterline.plans."""

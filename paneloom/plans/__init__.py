"""The layers end to end: standard ratings, entity panel, filled dataset, views."""

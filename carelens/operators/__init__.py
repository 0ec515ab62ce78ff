"""DataFrame operators over observation, encounter and identifier tables."""

"""Loads that go on from where the last one stopped."""

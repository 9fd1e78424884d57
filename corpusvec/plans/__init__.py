"""End-to-end plans: build an index, merge indexes, answer text queries."""

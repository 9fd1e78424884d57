"""Writing chunks, vectors, manifests and whole indexes."""

"""Text corpora as searchable vector tables, on Spark."""

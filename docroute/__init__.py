"""Document routing, deduplication and roll-up as Spark DataFrame operators."""

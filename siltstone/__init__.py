"""siltstone: layered (bronze, silver, gold) warehouse building blocks for Spark."""

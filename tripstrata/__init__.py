"""tripstrata: layered trip analytics on Spark (raw -> silver -> gold)."""

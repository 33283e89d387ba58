"""Station-flow analytics on PySpark: bike-share snapshots in, rentals and returns out."""

"""Supply-chain analytics as plain PySpark DataFrame functions."""

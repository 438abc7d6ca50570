"""Supply-chain and demand-planning operators as plain PySpark DataFrame code."""

"""Supply-chain risk scoring as lazy PySpark DataFrame transformations."""

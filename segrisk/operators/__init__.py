"""DataFrame -> DataFrame building blocks, independent of the risk model."""

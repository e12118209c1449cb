"""The risk model: jobs composed from the operators."""

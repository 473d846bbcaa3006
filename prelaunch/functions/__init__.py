"""Column functions: list decoding, scalar features, text tokens."""

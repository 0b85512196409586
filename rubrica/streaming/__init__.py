"""The stateless columns applied to file streams."""

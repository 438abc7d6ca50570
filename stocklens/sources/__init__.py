"""Input relations: their schemas, and how the test tables provide them."""

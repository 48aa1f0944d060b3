"""Analytics operators written as plain ``DataFrame -> DataFrame`` functions."""

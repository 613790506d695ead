"""Column functions: parsing guards and exact sums."""

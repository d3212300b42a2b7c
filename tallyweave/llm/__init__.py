"""Training-data operators on texts and noisy entities. Nothing outside this package imports it."""

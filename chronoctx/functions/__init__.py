"""Column functions: encoders, times, geometry, vocabularies, parameters."""

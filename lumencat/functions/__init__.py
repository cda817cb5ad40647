"""Column functions: random numbers, magnitudes, apertures, sky geometry."""

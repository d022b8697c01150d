"""Column functions: positions, units, names, beams and times."""

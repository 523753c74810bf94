"""Longitudinal register linkage on Spark: standardise waves, link them to
persistent firm and site identifiers, keep their history, publish and profile."""

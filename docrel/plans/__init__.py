"""Plans: the end-to-end queries, the physical-layout helpers and the mapping of
the university schema onto the driver's tables."""

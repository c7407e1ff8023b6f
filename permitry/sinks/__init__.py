"""Writers for reports, candidates, maps, final tables and the address cache."""

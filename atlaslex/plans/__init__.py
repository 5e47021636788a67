"""User-level stages. Each takes and returns DataFrames; results that feed several jobs are stage tables."""

"""Sources, table bindings and the jobs that write prepared tables."""

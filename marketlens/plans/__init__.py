"""Model graph: staging → intermediate → dims/facts → marts → analyses."""

"""Where relations and their dictionary come from."""

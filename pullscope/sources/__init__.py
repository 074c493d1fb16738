"""pullscope.sources."""

"""pullscope.plans."""

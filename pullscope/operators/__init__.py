"""pullscope.operators."""

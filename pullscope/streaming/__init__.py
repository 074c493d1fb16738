"""pullscope.streaming."""

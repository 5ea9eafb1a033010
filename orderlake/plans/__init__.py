"""Jobs, the pipeline and the registered queries."""

"""Empty on purpose: the analysis works on whole tables and has no streaming operators."""

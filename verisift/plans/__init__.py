"""End-to-end jobs and the bindings of the canonical entities to the test tables."""

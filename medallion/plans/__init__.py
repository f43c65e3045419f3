"""The review pipelines and the declared quality suites."""

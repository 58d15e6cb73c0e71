"""casewatch.plans."""

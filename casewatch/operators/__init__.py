"""casewatch.operators."""

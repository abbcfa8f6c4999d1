"""DataFrame -> DataFrame operators of the mart (clean, grade, resume, gold, report)."""

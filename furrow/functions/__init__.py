"""Column functions: text normalisation, scripts, ids, prose and vector arithmetic."""

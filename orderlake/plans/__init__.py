"""Layer builders (bronze, silver, gold), business metrics and the run."""

"""Ready analyses: ridership, pass-ups, jobs, equity scores, feeds, census measures."""

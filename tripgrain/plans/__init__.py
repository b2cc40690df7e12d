"""Reports, checks and the full refresh, declared as DataFrame plans."""

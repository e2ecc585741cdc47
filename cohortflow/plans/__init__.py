"""The models, checks and triage run, as DataFrame programs."""

"""Multi-operator plans: routing of a batch and the full batch run."""

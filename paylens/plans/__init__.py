"""Multi-step plans: layered batch run, warehouse models, metrics, recovery."""

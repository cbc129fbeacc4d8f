"""Multi-operator jobs: builds, backtests, models, monitoring reports."""

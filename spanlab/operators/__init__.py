"""DataFrame → DataFrame operators, fitted models, tuning, text, neighbours and pipeline stages."""

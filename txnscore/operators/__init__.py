"""DataFrame operators: features, scaling, balance, split, metrics, gates."""

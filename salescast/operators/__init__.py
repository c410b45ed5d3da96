"""DataFrame operators: profile, quality, cleaning, daily series, features, forecast."""

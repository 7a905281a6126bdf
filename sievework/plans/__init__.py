"""The flows a user runs, assembled from operators: land, clean, catalogue, feature, publish."""

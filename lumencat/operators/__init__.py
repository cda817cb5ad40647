"""DataFrame operators: selections, sampling, matching, statistics, photo-z."""

"""DataFrame operators: selection, joins with the observations, cleaning, reshaping, profile."""

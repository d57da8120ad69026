"""DataFrame operators: staging, game facts, joins, roll-ups, profiles and checks."""

"""DataFrame operators: latest version, tiles, measured joins, duration statistics, rules."""

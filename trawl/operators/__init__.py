"""Relational operators of the engine: index build, statistics, ranking, top-k."""

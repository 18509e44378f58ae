"""DataFrame operators of survey harmonisation."""

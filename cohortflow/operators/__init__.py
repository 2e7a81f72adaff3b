"""DataFrame operators of the compliance report."""

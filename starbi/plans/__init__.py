"""Query plans: the star pipeline and the analytical questions."""

"""Query registry, SQL oracle and plan checks."""

"""Query registry, its SQL oracle, and the end-to-end lakehouse run."""

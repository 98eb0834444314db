"""Column expressions (pure ``Column`` builders) and the exact-quantile helper."""

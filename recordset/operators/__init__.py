"""Operators: predicates, keyed lookups, keyed writes (versioned and bucketed), the segment report."""

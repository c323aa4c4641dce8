"""Column expressions: text cleaning, derivations, lookups; and the few functions that need Python."""

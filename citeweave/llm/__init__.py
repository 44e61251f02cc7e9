"""Operators that prepare a training corpus: cleaning, mixing, ordering, storing and scoring texts."""

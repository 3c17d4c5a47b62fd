"""DataFrame -> DataFrame operators: split, clean, quarantine, view, score, profile."""

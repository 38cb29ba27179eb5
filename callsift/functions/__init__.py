"""Column functions: text shaping, word tests, rules, speaker classes."""

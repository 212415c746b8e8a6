"""Column expressions: bucket rules, verdicts, safe division, repeatable hashing, normal and chi-square tails."""

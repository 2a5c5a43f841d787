"""ledgerline: statements, scores, rules and models over wide customer tables, written for Spark."""

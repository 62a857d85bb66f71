"""The pipelines, each with its own column contract, rules and result tables."""

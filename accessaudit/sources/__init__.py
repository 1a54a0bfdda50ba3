"""Where records and reference tables come from, and where verdicts go."""

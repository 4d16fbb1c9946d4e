"""Column helpers shared by the jobs: text keys, money, local days, numbering, size checks."""

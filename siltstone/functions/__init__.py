"""Column functions: typing, keys, dates, money, predicates, masking and scoring."""

from shelfmark.functions.money import as_money, huge_amount, line_amount, mean_money

__all__ = ["as_money", "huge_amount", "line_amount", "mean_money"]

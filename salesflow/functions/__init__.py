from salesflow.functions.measures import (bias_alert, exact_mean, exact_sum, inverse_log,
                                          is_null_flag, log_target, residual, smoothed_ape)
from salesflow.functions.pricing import (change_pct, elasticity_class, piece_price, pieces,
                                         price_strategy, revenue, scenario_price, unit_price)
from salesflow.functions.text import (clean_key, family_key, month_code, month_number,
                                      normalise_text, zone_code)

__all__ = ["bias_alert", "change_pct", "clean_key", "elasticity_class", "exact_mean",
           "exact_sum", "family_key", "inverse_log", "is_null_flag", "log_target",
           "month_code", "month_number", "normalise_text", "piece_price", "pieces",
           "price_strategy", "residual", "revenue", "scenario_price", "smoothed_ape",
           "unit_price", "zone_code"]

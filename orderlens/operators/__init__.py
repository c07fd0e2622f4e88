from orderlens.operators.calendar import key_range, weekday_list, zero_fill
from orderlens.operators.cleaning import clean_customer_orders, clean_runner_orders
from orderlens.operators.joins import not_in
from orderlens.operators.lists import explode_list, keyed_dimension, repeat_rows
from orderlens.operators.prefix import global_row_number, running_total
from orderlens.operators.ranking import dense_rank_keys, dense_rank_rows, keep_rank_one, rank_one, top_one

__all__ = [
    "key_range", "weekday_list", "zero_fill", "clean_customer_orders", "clean_runner_orders",
    "not_in", "explode_list", "keyed_dimension", "repeat_rows", "global_row_number", "running_total",
    "dense_rank_keys", "dense_rank_rows", "keep_rank_one", "rank_one", "top_one",
]

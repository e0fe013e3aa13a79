"""Column expressions shared by the operators."""

from basketflow.functions.exprs import (
    circular_hour_distance,
    id_list_string,
    ratio,
    round_doubles,
)

__all__ = ["ratio", "id_list_string", "circular_hour_distance", "round_doubles"]

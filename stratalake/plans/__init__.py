from stratalake.plans.bronze import EmptyInputError, run_bronze
from stratalake.plans.chain import run_all
from stratalake.plans.gold import refresh_gold, run_gold
from stratalake.plans.silver import run_silver

__all__ = ["EmptyInputError", "refresh_gold", "run_all", "run_bronze", "run_gold", "run_silver"]

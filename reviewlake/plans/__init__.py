"""Whole flows: landing, bronze, silver and gold."""

from reviewlake.plans.bronze import bronze_rows, run_bronze
from reviewlake.plans.gold import gold_rows, run_gold
from reviewlake.plans.landing import Landed, land_feed
from reviewlake.plans.run import RunResult
from reviewlake.plans.silver import run_silver, silver_rows

__all__ = ["Landed", "RunResult", "bronze_rows", "gold_rows", "land_feed", "run_bronze", "run_gold", "run_silver",
           "silver_rows"]

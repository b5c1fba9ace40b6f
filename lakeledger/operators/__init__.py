"""DataFrame -> DataFrame operators of each layer, plus the generator and audits."""

from lakeledger.operators.bronze import split_parseable, tag_parseable, to_bronze
from lakeledger.operators.generate import DefectRates, generate_log, generate_transactions
from lakeledger.operators.gold import affected_dates, daily_account_totals, rebuild
from lakeledger.operators.quality import DataQualityBreach, breaches, dq_results, dq_results_by, dq_trend, enforce_gate
from lakeledger.operators.silver import deduplicate, flag_lateness, judged, to_silver, validate

__all__ = [
    "split_parseable", "tag_parseable", "to_bronze", "DefectRates", "generate_log", "generate_transactions",
    "affected_dates", "daily_account_totals", "rebuild", "DataQualityBreach", "breaches", "dq_results",
    "dq_results_by", "dq_trend", "enforce_gate", "deduplicate", "flag_lateness", "judged", "to_silver", "validate",
]

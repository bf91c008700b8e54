"""Incremental planning, the ledger and the job."""

from daybar.plans.backfill import DayPlan, calendar, day_ranges, plan_days, plan_days_keyed, plan_frame
from daybar.plans.intents import Intent, open_intent, recover_intent
from daybar.plans.job import RunResult, build_report, run
from daybar.plans.ledger import LEDGER_COLUMNS, append_ledger, check_ledger_days, import_ledger, ledger_day, ledger_days, read_ledger

__all__ = [
    "LEDGER_COLUMNS", "DayPlan", "Intent", "RunResult", "append_ledger", "build_report", "calendar", "check_ledger_days",
    "day_ranges", "import_ledger", "ledger_day", "ledger_days", "open_intent", "plan_days", "plan_days_keyed", "plan_frame", "read_ledger",
    "recover_intent", "run",
]

"""Q12: which columns the finance mart's facts have, of which types, and which they must not have."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

#: Whole numbers of any width: surrogate keys are longs, flags and counts ints.
WHOLE = "whole number"
_WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")
_MONEY = "decimal(18,2)"
_AUDIT = {"etl_batch_id": WHOLE, "loaded_at": "timestamp_ntz"}


@dataclass(frozen=True)
class Contract:
    """``columns``: name -> type (or WHOLE). With ``closed``, no other column may be there; ``forbidden`` names may never be."""

    columns: dict[str, str]
    forbidden: tuple[str, ...] = ()
    closed: bool = True


def _keys(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, WHOLE)


# The columns of the finance mart's facts, and those that readers rely on not to be there.
MART2_CONTRACT = {
    "fact_donation_transaction": Contract(
        {**_keys("date_key", "donor_key", "campaign_key", "center_key", "donation_type_key", "currency_key", "status_key"), "amount": _MONEY,
         "is_confirmed": WHOLE, "is_refunded": WHOLE, **_AUDIT}, ("source_donation_id", "source_donation_code", "source_system")),
    "fact_expense_transaction": Contract(
        {**_keys("date_key", "center_key", "child_key", "category_key", "currency_key", "status_key"), "amount": _MONEY, "is_approved": WHOLE,
         "is_rejected": WHOLE, **_AUDIT}, ("source_expense_id", "source_expense_code", "description", "source_system")),
    "fact_payment_transaction": Contract(
        {**_keys("date_key", "center_key", "currency_key", "status_key"), "payment_type": "string", "amount": _MONEY, "is_paid": WHOLE,
         "is_cancelled": WHOLE, **_AUDIT}, ("source_payment_id", "source_payment_code", "source_system")),
    "fact_monthly_financial_snapshot": Contract(
        {**_keys("month_key", "center_key"), "total_donation_amount": _MONEY, "total_expense_amount": _MONEY, "total_payment_amount": _MONEY,
         "net_balance": _MONEY, **_keys("donation_count", "expense_count", "payment_count", "allocation_count"), **_AUDIT}, ("source_system",)),
    "fact_donation_lifecycle": Contract(
        {**_keys("donor_key", "campaign_key", "created_date_key", "confirmed_date_key", "allocated_date_key", "lifecycle_status_key"),
         "current_stage": "string", "donation_amount": _MONEY, "min_donation": _MONEY, "max_donation": _MONEY, "avg_donation": _MONEY, **_AUDIT},
        ("source_donation_id", "days_to_confirm", "days_to_allocate", "source_system")),
    "fact_budget_allocation_event": Contract(
        {**_keys("date_key", "donor_key", "center_key", "child_key", "category_key", "campaign_key"), **_AUDIT},
        ("source_allocation_id", "allocated_amount", "reason", "allocation_type_key", "source_system")),
    **{f"dim_{name}": Contract({f"{name}_key": WHOLE}, ("source_system",), closed=False)
       for name in ("donor", "campaign", "category", "donation_type", "status", "currency")},
}


def contract_problems(df: DataFrame, contract: Contract) -> list[str]:
    """What breaks the contract, in its order, then other columns by name; an empty list if nothing does."""
    types, out = dict(df.dtypes), []
    for name, kind in contract.columns.items():
        if name not in types:
            out.append(f"{name}: missing")
        elif types[name] not in (_WHOLE_TYPES if kind == WHOLE else (kind,)):
            out.append(f"{name}: {types[name]} instead of {kind}")
    return out + [f"{name}: must not be there" for name in sorted(types)
                  if name in contract.forbidden or (contract.closed and name not in contract.columns)]

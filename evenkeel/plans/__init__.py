"""Whole jobs put together from sources, operators and sinks."""

from evenkeel.plans.digest import DigestReconciliation, reconcile_by_digest
from evenkeel.plans.reconcile import Reconciliation, reconcile

__all__ = ["DigestReconciliation", "Reconciliation", "reconcile", "reconcile_by_digest"]

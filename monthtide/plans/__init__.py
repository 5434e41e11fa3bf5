"""Which files are due, and the monthly load and merge over them."""

from monthtide.plans.assets import due_spans, plan_assets

__all__ = ["due_spans", "plan_assets"]

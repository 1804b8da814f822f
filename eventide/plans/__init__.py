"""Physical-plan helpers: bounded broadcast, plan inspection, lineage cuts."""

from eventide.plans.broadcast import bounded_broadcast  # noqa: F401
from eventide.plans.inspect import plan_text, assert_plan  # noqa: F401
from eventide.plans.lineage import cut_lineage, materialize  # noqa: F401

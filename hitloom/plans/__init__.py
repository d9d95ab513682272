from hitloom.plans.batch import run_batch
from hitloom.plans.layout import Layout
from hitloom.plans.local import strip_local, two_sided_local, wire_local
from hitloom.plans.pulses import calibrated_pulses
from hitloom.plans.strip import STRIP_PLANES, StripPlane, strip_plan
from hitloom.plans.trigger import trigger_plan
from hitloom.plans.two_sided import TwoSided, two_sided_plan
from hitloom.plans.wire import wire_plan

__all__ = [
    "STRIP_PLANES",
    "Layout",
    "StripPlane",
    "TwoSided",
    "calibrated_pulses",
    "run_batch",
    "strip_local",
    "strip_plan",
    "trigger_plan",
    "two_sided_local",
    "two_sided_plan",
    "wire_local",
    "wire_plan",
]
